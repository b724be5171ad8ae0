"""tessera: a Spark-native text-to-topics engine.

Every stage is a DataFrame -> DataFrame function that runs on the cluster:
cleaning and keep-first dedup, n-gram bag-of-words and TF-IDF weighting with
document-frequency and vocabulary-size limits, matrix statistics, LDA and LSA
topic models, top-term ranking and the report sinks.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package run inside Spark tasks (mapInPandas bodies);
    pickle them by value so executors need not have the package installed."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
