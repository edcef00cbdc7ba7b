"""Dimension lookups: broadcast when the small side is proven small, else a
salted shuffle join that survives hot keys.

A lookup table (rule table, model table, per-feature weights) is small in
practice but nothing in the schema bounds it. `lookup_join` counts it
first; only under `max_broadcast_rows` is it broadcast. Above it, both
sides shuffle on (key, salt): the big side takes a deterministic salt from
a hash of its row key, the small side is replicated once per salt, so a
key holding a third of the rows spreads over `salts` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
DEFAULT_SALTS = 64


def row_count(df: DataFrame) -> int:
    return df.count()


def lookup_join(big: DataFrame, small: DataFrame, on: list[str] | str, how: str = "left",
                row_key: list[str] | None = None, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                salts: int = DEFAULT_SALTS, small_rows: int | None = None) -> DataFrame:
    """`big` JOIN `small` USING (`on`); `small` must be unique on `on`."""
    on = [on] if isinstance(on, str) else list(on)
    n = row_count(small) if small_rows is None else small_rows
    if n <= max_broadcast_rows:
        return big.join(F.broadcast(small), on, how)
    key_cols = row_key or [c for c in big.columns if c not in on][:1] or on
    salted_big = big.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(salts)).cast("int"))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_small, on + ["_salt"], how).drop("_salt")
