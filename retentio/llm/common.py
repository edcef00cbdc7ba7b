"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(*cols: Column) -> list[Column]:
    """Two never-null 64-bit hashes that stand for the given values; rows
    that agree in all of them share the key. Joins on the pair are plain
    equi-joins even where doc_id is null or repeated."""
    return [F.xxhash64(*cols).alias("_k1"),
            F.xxhash64(F.lit("second"), *cols).alias("_k2")]


#: bytes of one Arrow batch that goes to a Python worker
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session in bytes: a run of long texts
    then takes no more of a Python worker's memory than one of short ones."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


KEY = ["_k1", "_k2"]
ROW = "_row"


def whole_row() -> Column:
    """All columns of a table as one struct, so that names an operator uses
    on its way can't clash with the table's own."""
    return F.struct("*").alias(ROW)
