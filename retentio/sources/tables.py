"""Scans: driver tables, raw subscriber CSV, intermediate tables, config."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw subscriber layout. Numbers that the source writes as text
# (TotalCharges) are read as strings and parsed leniently later (B1).
SUBSCRIBER_SCHEMA = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.DoubleType()),
    T.StructField("PhoneService", T.StringType()),
    T.StructField("MultipleLines", T.StringType()),
    T.StructField("InternetService", T.StringType()),
    T.StructField("OnlineSecurity", T.StringType()),
    T.StructField("OnlineBackup", T.StringType()),
    T.StructField("DeviceProtection", T.StringType()),
    T.StructField("TechSupport", T.StringType()),
    T.StructField("StreamingTV", T.StringType()),
    T.StructField("StreamingMovies", T.StringType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaperlessBilling", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.StringType()),
    T.StructField("Churn", T.StringType()),
])

# ---- fixed values: raw file names tried in order ---------------------------
RAW_CANDIDATES = ("Churn_Telco.csv", "telco_customer_churn.csv")
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (one parquet file/folder per table)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_raw(spark: SparkSession, folder: str, filename: str | None = None,
             schema: T.StructType = SUBSCRIBER_SCHEMA) -> DataFrame:
    """A1: first existing candidate file wins; the error lists all tried.
    Malformed lines are left out (`ingest_raw` keeps them)."""
    return _first_candidate(spark, folder, filename, schema, read_csv)


def _first_candidate(spark: SparkSession, folder: str, filename: str | None,
                     schema: T.StructType, reader):
    candidates = ([filename] if filename else []) + list(RAW_CANDIDATES)
    for fn in candidates:
        try:
            # the reader checks the path when the relation is resolved
            return reader(spark, f"{folder.rstrip('/')}/{fn}", schema)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"Missing raw dataset in {folder}. Tried: {candidates}")


#: column of a parsed file that holds a malformed line
MALFORMED = "_malformed_line"


def _parsed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The schema's columns and MALFORMED. Columns are taken by their header
    names, so their order in the file does not matter; names that the schema
    has and the file lacks are null. A line that has not as many fields as
    the header has is malformed: its text is kept and its columns are null.
    Explicit types, no inference pass over the data."""
    header = spark.read.option("header", True).csv(path)
    have = {c.lower(): c for c in header.columns}
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*header.columns, MALFORMED]])
    raw = (spark.read.schema(text).option("header", True).option("enforceSchema", False)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).csv(path))
    bad = F.col(MALFORMED).isNotNull()
    return raw.select(*[
        (F.when(~bad, F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType))
         if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields], F.col(MALFORMED))


def read_csv(spark: SparkSession, path: str,
             schema: T.StructType = SUBSCRIBER_SCHEMA) -> DataFrame:
    """A2: fixed-name CSV scan of the lines that are well-formed."""
    return _parsed_csv(spark, path, schema).filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


@dataclass
class Ingested:
    """Rows of a raw file, its malformed lines, and how many of each."""

    rows: DataFrame
    quarantine: DataFrame          # line
    n_rows: int
    n_malformed: int


def ingest_csv(spark: SparkSession, path: str, out: str,
               schema: T.StructType = SUBSCRIBER_SCHEMA) -> Ingested:
    """A2 with a quarantine: the file is read once and written to `out` in
    two partitions, well-formed rows and malformed lines; both are counted
    in the same pass. A malformed line is in the quarantine and in no other
    table, and no line fails the job."""
    bad = F.col(MALFORMED).isNotNull()
    seen = Observation("ingest_csv")
    (_parsed_csv(spark, path, schema).withColumn("malformed", bad)
     .observe(seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("malformed"))
     .write.mode("overwrite").partitionBy("malformed").parquet(out))
    # the types are known: an empty table has no partition to read them from
    kept = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType()),
                         T.StructField("malformed", T.BooleanType())])
    table = spark.read.schema(kept).parquet(out)
    return Ingested(table.filter(~F.col("malformed")).drop("malformed", MALFORMED),
                    table.filter(F.col("malformed")).select(F.col(MALFORMED).alias("line")),
                    seen.get["rows"], seen.get["malformed"])


def ingest_raw(spark: SparkSession, folder: str, out: str, filename: str | None = None,
               schema: T.StructType = SUBSCRIBER_SCHEMA) -> Ingested:
    """A1 + A2: the first existing candidate file, with a quarantine."""
    return _first_candidate(spark, folder, filename, schema,
                            lambda s, path, sch: ingest_csv(s, path, out, sch))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A3: re-read an intermediate table written by a sink."""
    return spark.read.parquet(path)


def load_config(spark: SparkSession, path: str) -> dict:
    """A small JSON policy document, read through Spark's file system
    layer (works for any Hadoop-compatible path)."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        raise FileNotFoundError(path) from e
    if row is None:
        raise FileNotFoundError(path)
    return json.loads(row[0])
