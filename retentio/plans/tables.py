"""Table boundaries between jobs (A4, A10).

The reference passes CSV files between its stages. Here a stage boundary
is a Parquet table in the shared checkpoint folder: the job writes once,
later jobs read it back with column pruning and predicate pushdown, and
the lineage is cut (a lost executor re-reads files instead of recomputing
the model). It also stops the optimizer from inlining a long chain of
rule expressions into every predicate that is pushed down.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, ensure_checkpoint_dir
from .manifest import fingerprint, read_manifest, write_manifest


def scratch_path(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write `df` as Parquet (shared folder) and return the re-read table."""
    spark = df.sparkSession
    p = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


def bucketed(df: DataFrame, name: str, key: str = "customerID", buckets: int | None = None,
             path: str | None = None) -> DataFrame:
    """Write `df` as a table bucketed (and sorted) by `key` in the shared
    folder. Two tables bucketed on the same key with the same bucket count
    join without a shuffle on either side (sort-merge join over matching
    buckets), which is how the scored rows and the decision table meet. A
    Bloom filter on the key lets a point look-up skip the row groups of its
    bucket that lack it."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    p = path or scratch_path(spark, name)
    table = f"retentio_{name}_{uuid.uuid4().hex[:12]}"
    # hash-partition on the key first (same hash as bucketing): one writer
    # per bucket, so 1000 tasks x n buckets do not become 1000 x n small files
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key).mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option("path", p).saveAsTable(table))
    return spark.table(table)


def ensure_table(spark: SparkSession, path: str, builder,
                 inputs: dict[str, DataFrame] | None = None) -> DataFrame:
    """A10: read the table at `path`; build and write it first when missing,
    or when the fingerprint of one of its `inputs` is no longer the one in
    the table's manifest. The manifest is written last: a build that was cut
    off is done again."""
    seen = {name: fingerprint(df) for name, df in (inputs or {}).items()}
    fresh = _committed(spark, path)
    if fresh and inputs:
        fresh = (read_manifest(spark, path) or {}).get("inputs") == seen
    if not fresh:
        builder().write.mode("overwrite").parquet(path)
        if inputs:
            write_manifest(spark, path, {"inputs": seen})
    return spark.read.parquet(path)


def _committed(spark: SparkSession, path: str) -> bool:
    """True when the writer's commit marker stands in the folder."""
    try:
        spark.read.format("binaryFile").load(f"{path.rstrip('/')}/_SUCCESS").schema
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def write_table(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """A4: table sink."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4/A5: CSV export with a header (one file per task; no single-task
    coalesce, so exports of any size stay parallel)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines sink (metrics records)."""
    df.write.mode(mode).json(path)
