"""Threshold economics, curves and reports against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentio.operators import evaluate as Ev


def frame(spark, scores, labels):
    return spark.createDataFrame(list(zip([float(s) for s in scores], [int(y) for y in labels])),
                                 "score double, label int")


def brute_curve(scores, labels, c_fn=200.0, c_fp=50.0):
    out = []
    for t in np.linspace(0, 1, 101):
        pred = [s >= t for s in scores]
        tp = sum(p and y == 1 for p, y in zip(pred, labels))
        fp = sum(p and y == 0 for p, y in zip(pred, labels))
        fn = sum((not p) and y == 1 for p, y in zip(pred, labels))
        out.append((float(t), tp, fp, fn, fn * c_fn + fp * c_fp))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_cost_curve_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    # scores exactly on grid points, ties, 0 and 1
    scores = [round(rnd.random(), 2) for _ in range(300)] + [0.0, 1.0, 0.07, 0.07, 0.29, 0.58]
    labels = [rnd.randint(0, 1) for _ in scores]
    got = sorted((r["threshold"], r["tp"], r["fp"], r["fn"], r["cost"])
                 for r in Ev.cost_curve(frame(spark, scores, labels)).collect())
    want = brute_curve(scores, labels)
    assert [g[1:] for g in got] == [w[1:] for w in want]
    assert [g[0] for g in got] == [w[0] for w in want]     # exact linspace values
    best = Ev.best_threshold(Ev.cost_curve(frame(spark, scores, labels))).first()
    costs = [w[4] for w in want]
    assert best["threshold"] == want[int(np.argmin(costs))][0]


def test_single_class_counts(spark):
    df = frame(spark, [0.1, 0.5, 0.9], [0, 0, 0])
    curve = {round(r["threshold"], 2): r for r in Ev.cost_curve(df).collect()}
    assert curve[0.0]["fp"] == 3 and curve[0.0]["cost"] == 150.0     # correct counts
    m = Ev.metrics_record(df).first()
    assert m["auc"] is None and m["positives"] == 0


def test_published_golden_counts(spark):
    # TP 314, FN 60, FP 360, TN 675 at threshold 0.22 -> cost 30,000
    rows = [(0.9, 1)] * 314 + [(0.1, 1)] * 60 + [(0.9, 0)] * 360 + [(0.1, 0)] * 675
    df = spark.createDataFrame(rows, "score double, label int")
    c = Ev.confusion(df, 0.22).first()
    assert (c["tp"], c["fn"], c["fp"], c["tn"]) == (314, 60, 360, 675)
    r = Ev.rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    got = Ev.confusion(df, 0.22).select(*[v.alias(k) for k, v in r.items()]).first()
    assert round(got["recall"], 4) == 0.8396
    assert round(got["precision"], 4) == 0.4659
    assert round(got["specificity"], 4) == 0.6522
    assert 60 * 200 + 360 * 50 == 30000
    rep = {r["class"]: r for r in Ev.classification_report(Ev.confusion(df, 0.22)).collect()}
    assert round(rep["0"]["precision"], 2) == 0.92 and round(rep["1"]["f1_score"], 2) == 0.60
    assert round(rep["accuracy"]["f1_score"], 2) == 0.70
    assert round(rep["macro avg"]["f1_score"], 2) == 0.68
    assert round(rep["weighted avg"]["f1_score"], 2) == 0.72


def test_auc_and_pr_against_sklearn_formulas(spark):
    rnd = random.Random(7)
    scores = [round(rnd.random(), 1) for _ in range(400)]          # many ties
    labels = [1 if rnd.random() < s else 0 for s in scores]
    df = frame(spark, scores, labels)
    auc = Ev.auc(df).first()["auc"]
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    mw = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(mw, abs=1e-12)
    pr = {r["threshold"]: r for r in Ev.pr_curve(df).collect()}
    for t in set(scores):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 1)
        fp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 0)
        assert pr[t]["precision"] == pytest.approx(tp / (tp + fp))
        assert pr[t]["recall"] == pytest.approx(tp / len(pos))


def test_running_totals_across_ranges(spark):
    from retentio.plans.prefix import running_totals
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).alias("v"),
                                     (F.col("id") % 3).alias("g"))
    out = running_totals(df, [F.col("id").asc()], ["v"], ["g"], ranges=5, index="pos")
    got = {r["id"]: (r["cum_v"], r["pos"]) for r in out.collect()}
    for g in range(3):
        acc, pos = 0, 0
        for i in range(g, 1000, 3):
            acc += i % 7
            assert got[i] == (acc, pos)
            pos += 1


def test_deciles_follow_qcut(spark):
    import pandas as pd
    rnd = random.Random(3)
    scores = [round(rnd.random(), 2) for _ in range(500)] + [0.5] * 200
    labels = [rnd.randint(0, 1) for _ in scores]
    got = {round(r["score"], 6): r["decile"] for r in
           Ev.with_decile(frame(spark, scores, labels)).collect()}
    want = pd.qcut(pd.Series(scores), 10, labels=False, duplicates="drop")
    for s, d in zip(scores, want):
        assert got[round(s, 6)] == d


def test_calibration_bins(spark):
    df = frame(spark, [0.0, 0.1, 0.1000001, 0.95, 1.0], [0, 0, 1, 1, 1])
    bins = {r["bin"]: r["n"] for r in Ev.calibration_curve(df).collect()}
    assert bins == {0: 2, 1: 1, 9: 2}


def test_grid_count_property(spark):
    """grid_count(score) equals the number of linspace(0, 1, 101) points <= score."""
    from hypothesis import given, settings, strategies as st
    grid = np.linspace(0, 1, 101)

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(st.floats(0, 1), st.sampled_from([float(g) for g in grid]),
                              st.sampled_from([float(np.nextafter(g, 2)) for g in grid]),
                              st.sampled_from([float(np.nextafter(g, -1)) for g in grid])),
                    min_size=1, max_size=200))
    def check(scores):
        df = spark.createDataFrame([(s,) for s in scores], "score double")
        got = [r[0] for r in df.select(Ev.grid_count(F.col("score"))).collect()]
        assert got == [int(np.sum(grid <= s)) for s in scores]

    check()


def test_metrics_document_roundtrip(spark):
    df = spark.createDataFrame([("m1", 1, 0.9), ("m1", 0, 0.2), ("m2", 1, 0.4), ("m2", 0, 0.6)],
                               "model string, label int, score double")
    rec = Ev.metrics_record(df, 0.5, ["model"])
    doc = Ev.metrics_document(rec)
    assert doc.count() == 1 and doc.first()[0].startswith('{"m1":')
    back = {r["model"]: r for r in Ev.parse_metrics_document(doc).collect()}
    assert back["m1"]["auc"] == 1.0 and back["m2"]["auc"] == 0.0 and back["m2"]["n"] == 2


def test_grouped_running_totals_from_shuffled_input(spark):
    """Input order after a shuffle is not stable between executions; range
    ids must still agree between the local sums and the offsets."""
    from retentio.plans.prefix import running_totals
    base = spark.range(0, 40000).select((F.col("id") % 4).alias("g"), (F.col("id") % 9973).alias("k"))
    agg = base.groupBy("g", "k").agg(F.count(F.lit(1)).alias("v"))          # shuffled order
    out = running_totals(agg, [F.col("k").desc()], ["v"], ["g"], ranges=8, index="pos")
    got = {(r["g"], r["k"]): (r["cum_v"], r["pos"]) for r in out.collect()}
    pdf = agg.toPandas().sort_values(["g", "k"], ascending=[True, False])
    pdf["cum"] = pdf.groupby("g")["v"].cumsum()
    pdf["pos"] = pdf.groupby("g").cumcount()
    for r in pdf.itertuples():
        assert got[(r.g, r.k)] == (r.cum, r.pos)
    grouped_auc = {r["model"]: r["auc"] for r in Ev.auc(
        agg.select(F.col("g").cast("string").alias("model"), (F.col("k") % 2).cast("int").alias("label"),
                   (F.col("k") / 9973.0).alias("score")), ["model"]).collect()}
    assert set(grouped_auc) == {"0", "1", "2", "3"}
