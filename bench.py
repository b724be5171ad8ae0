"""Benchmark: the full text-to-topics run at $BENCH_SF_DIR on local[$BENCH_CPUS].

Runs the reference's configuration (vocabulary 20 000, 1-2-grams, min_df 2,
10 topics, 15 top terms, 20 iterations, seed 42) over the whole `documents`
table, writing every artifact, and prints one JSON line with per-stage
seconds.  Stage boundaries are the materialization points of the run
(normalized stage, term table, vocabulary + matrices, model fits, writes).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.config import CleanConfig, PipelineConfig, TopicConfig, VectorizeConfig
    from tessera.plans import batch as PL
    from tessera.session import local_session, scratch_path
    from tessera.sources.corpus import read_table

    t_start = time.time()
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app_name="tessera-bench")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-bench-"))
    t_session = time.time() - t_start

    raw = read_table(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text", "lang", "source"])
    cfg = PipelineConfig(
        clean=CleanConfig(text_col="text"),
        vectorize=VectorizeConfig(max_features=20000, ngram_range=(1, 2), min_df=2),
        topics=TopicConfig(n_topics=10, n_top_terms=15, n_iter=20, random_state=42))
    out = scratch_path(spark, "bench-out")
    t0 = time.time()
    result = PL.run(spark, raw, cfg, outdir=out)
    total = time.time() - t0
    timings = dict(result.meta.get("timings", {}))
    n_docs = result.bow.n_docs
    queries = {f"stage_{k}": v for k, v in timings.items()}
    queries["total"] = round(total, 3)
    print(json.dumps({
        "metric": "text_to_topics_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "n_docs": n_docs,
        "vocabulary": result.bow.vocab.size,
        "session_start_sec": round(t_session, 3),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
