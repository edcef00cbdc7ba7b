"""Running totals and positions over a global order without a single task.

A window with no PARTITION BY moves every row to one task. Here the rows
are range-partitioned on (group, order): each range is a contiguous slice
of the order with a bounded share of the rows (a key holding a third of the
rows can only fill the ranges it spans, because the order ends in a unique
tie-breaker). Then:

1. a running sum inside each (group, range), ordered;
2. one total per (group, range) — at most groups + ranges rows;
3. the offset of each range = sum of earlier ranges' totals in the group
   (a window over that small table);
4. running value = offset + local running sum.

The range id comes from a sampled range exchange, and a second execution
of that exchange (another job, or a recomputation) may draw different
bounds. So the rows are written once with their range id (a table in the
shared checkpoint folder) and every later branch reads the same ids; a
lost executor re-reads files instead of re-ranging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import lookup_join
from .tables import materialize


def _ranges(df: DataFrame, ranges: int | None) -> int:
    if ranges:
        return ranges
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def running_totals(df: DataFrame, order: list[Column], sums: list[str],
                   partition_by: list[str] = (), ranges: int | None = None,
                   prefix: str = "cum_", index: str | None = None,
                   totals_prefix: str | None = None) -> DataFrame:
    """Adds `prefix + c` = sum of `c` over rows up to and including this one
    in `order` within `partition_by`; `order` must be a total order (end it
    with a unique key). `index`, when given, names a 0-based position.
    `totals_prefix`, when given, also adds the group total of each `c`
    (taken from the range totals, no extra pass over the rows)."""
    partition_by = list(partition_by)
    work = df
    if index:
        work = work.withColumn("_one", F.lit(1))
        sums = list(sums) + ["_one"]
    n_ranges = _ranges(df, ranges)
    ranged = materialize(
        work.repartitionByRange(n_ranges, *[F.col(c) for c in partition_by], *order)
        .withColumn("_r", F.spark_partition_id()), "ranges")
    w_local = (Window.partitionBy(*partition_by, "_r").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumns({f"_l_{c}": F.sum(c).over(w_local) for c in sums})
    totals = ranged.groupBy(*partition_by, "_r").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    w_off = (Window.partitionBy(*partition_by).orderBy("_r")
             .rowsBetween(Window.unboundedPreceding, -1))
    w_all = Window.partitionBy(*partition_by)
    group = F.struct(*partition_by) if partition_by else F.lit(0)
    local = local.withColumn("_grp", group)
    offsets = totals.select(group.alias("_grp"), "_r", *[
        F.coalesce(F.sum(f"_t_{c}").over(w_off), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *([F.sum(f"_t_{c}").over(w_all).alias(f"{totals_prefix}{c}") for c in sums
           if c != "_one"] if totals_prefix else []))
    # without groups the offsets table has at most `n_ranges` rows: a proven
    # bound, so it is broadcast without counting; with groups it is counted
    # a struct of the group columns equals itself where they are null
    out = lookup_join(local, offsets, ["_grp", "_r"], "inner",
                      small_rows=None if partition_by else n_ranges)
    cols = {}
    for c in sums:
        if c == "_one":
            cols[index] = F.col("_o__one") + F.col("_l__one") - 1
        else:
            cols[prefix + c] = F.col(f"_o_{c}") + F.col(f"_l_{c}")
    out = out.withColumns(cols)
    return out.drop("_r", "_one", "_grp", *[f"_l_{c}" for c in sums], *[f"_o_{c}" for c in sums])


def position_in_group(df: DataFrame, partition_by: list[str], order: list[Column],
                      out: str = "position", ranges: int | None = None) -> DataFrame:
    """0-based sorted position within a group (= row_number - 1),
    without sending a whole group to one task."""
    return running_totals(df, order, [], partition_by, ranges, index=out)
