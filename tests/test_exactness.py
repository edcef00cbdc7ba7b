"""Answers that must not depend on size, order of columns or odd values."""

import statistics

import pytest
from pyspark.sql import functions as F

from retentio.functions import cleaning as C
from retentio.operators import evaluate as Ev
from retentio.operators import value as V
from retentio.plans.prefix import position_in_group
from retentio.plans.quantiles import exact_quantiles
from retentio.plans.tables import ensure_table, scratch_path
from retentio.sources.tables import read_csv


@pytest.mark.parametrize("ranges", [1, 64])
def test_quantiles_are_the_same_with_any_number_of_ranges(spark, ranges):
    values = [1.0, 2.0, 3.0, 10.0, None]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0), (None, 5.0), (None, 6.0)],
                               "g string, v double")
    got = {r["g"]: r["q"] for r in
           exact_quantiles(df, F.col("v"), [0.0, 0.5, 1.0], ["g"], ranges).collect()}
    assert got == {"a": [1.0, 2.5, 10.0], "b": [7.0, 7.0, 7.0], None: [5.0, 5.5, 6.0]}
    many = spark.range(1, 1002).select((F.col("id") % 97).cast("double").alias("v"))
    q = exact_quantiles(many, F.col("v"), [0.33, 0.66], (), ranges).first()["q"]
    ordered = sorted(i % 97 for i in range(1, 1002))
    for p, x in zip((0.33, 0.66), q):
        at = p * (len(ordered) - 1)
        lo = int(at)
        assert x == pytest.approx(ordered[lo] + (at - lo) * (ordered[lo + 1] - ordered[lo]))
    assert statistics.median(ordered) == exact_quantiles(
        many, F.col("v"), [0.5], (), ranges).first()["q"][0]


def test_positions_keep_rows_of_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "g string, k int")
    got = sorted((r["g"] or "", r["position"]) for r in
                 position_in_group(df, ["g"], [F.col("k")]).collect())
    assert got == [("", 0), ("", 1), ("a", 0), ("a", 1)]


def test_auc_of_huge_classes(spark, monkeypatch):
    big = 4 * 10 ** 9
    pts = spark.createDataFrame([(0.9, big, 0, big, big, 0), (0.1, 0, big, big, big, big)],
                                "score double, pos long, neg long, P long, N long, fps long")
    monkeypatch.setattr(Ev, "score_points", lambda df, group=(): pts)
    assert Ev.auc(pts).first()["auc"] == pytest.approx(1.0)


def test_odd_numbers_become_null(spark):
    df = spark.createDataFrame([("NaN",), ("10d",), ("Infinity",), (" 5.5 ",), ("-1",), ("",),
                                (None,)], "t string")
    got = [r[0] for r in df.select(C.lenient_double("t")).collect()]
    assert got == [None, None, None, 5.5, -1.0, None, None]
    nan = spark.createDataFrame([(float("nan"),)], "v double")
    assert nan.select(C.non_negative_or_null("v")).first()[0] is None
    assert nan.select(V.value_segment_fixed(F.col("v"))).first()[0] == "low"


def test_csv_columns_follow_the_header(spark):
    path = scratch_path(spark, "reordered")
    spark.createDataFrame([("Yes", "c1", "20.5")], "Churn string, customerID string, "
                          "MonthlyCharges string").write.option("header", True).csv(path)
    row = read_csv(spark, path).first()
    assert (row["customerID"], row["Churn"], float(row["MonthlyCharges"])) == ("c1", "Yes", 20.5)


def test_a_table_without_commit_marker_is_built_again(spark):
    path = scratch_path(spark, "half")
    (spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .parquet(path))
    assert ensure_table(spark, path, lambda: spark.range(5)).count() == 5
    assert ensure_table(spark, path, lambda: spark.range(9)).count() == 5
