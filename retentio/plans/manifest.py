"""Manifests: what a table or model was built from.

A manifest is a small JSON document in a folder beside the table
(`<path>.manifest`). It holds a fingerprint of each input: row count, sum and
exclusive-or of the rows' hashes, and the schema. The fingerprint does not
depend on the order or the partitions of the rows and takes one pass with
one row per task.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(df: DataFrame) -> str:
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    r = df.select(h.alias("h")).agg(
        F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("s"),
        F.bit_xor("h").alias("x")).first()
    return digest([df.schema.simpleString(), r["n"], str(r["s"]), r["x"]])


def digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


def _place(path: str) -> str:
    return f"{path.rstrip('/')}.manifest"


def write_manifest(spark: SparkSession, path: str, document: dict) -> None:
    rows = spark.createDataFrame([(json.dumps(document, sort_keys=True),)], "value string")
    rows.coalesce(1).write.mode("overwrite").text(_place(path))


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of a table or model; None where there is none."""
    try:
        row = spark.read.text(_place(path)).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return json.loads(row["value"]) if row else None
