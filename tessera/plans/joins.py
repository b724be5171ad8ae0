"""Join helpers: broadcast only what has a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes a side may have to be broadcast (vocabulary, dictionaries, models).
BROADCAST_MAX_BYTES = 64 << 20
#: Bytes of a row beside its texts.
ROW_BYTES = 48


def table_bytes(df: DataFrame) -> int:
    """Measured size of a table: its rows and the bytes of their texts."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{n}`")), F.lit(0)) for n, t in df.dtypes if t == "string"]
    width = sum(texts, F.lit(ROW_BYTES).cast("long"))
    return df.agg(F.sum(width)).first()[0] or 0


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               known_bytes: int | None = None,
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join ``big`` with a side that is usually small.

    ``known_bytes`` is a size the caller has measured already; without one the
    side is measured.  Within the limit the side is broadcast (no shuffle of
    ``big``); beyond it the join is left to a shuffle join, which AQE may still
    turn into a broadcast at run time.
    """
    n = known_bytes if known_bytes is not None else table_bytes(small)
    side = F.broadcast(small) if n <= max_bytes else small
    return big.join(side, on=on, how=how)
