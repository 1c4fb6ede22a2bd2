"""Join helper: broadcast a side only behind a measured size in bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest side that is broadcast on the strength of a measured size.
BROADCAST_BYTES = 32 << 20


def sized_join(big: DataFrame, small: DataFrame, on, how: str = "inner", known_bytes: int | None = None,
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` to ``small``, broadcasting ``small`` only when ``known_bytes``, as
    the caller measured it, is at most ``max_bytes``.

    Beyond the bound, or with no measure, Spark chooses from its own statistics, and in a
    shuffle join AQE splits skewed keys.
    """
    return big.join(F.broadcast(small) if known_bytes is not None and known_bytes <= max_bytes else small, on, how)
