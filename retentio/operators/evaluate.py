"""Model evaluation and threshold economics.

Input frames carry `label` (0/1 int) and `score` (double), optionally a
`model` column to evaluate several models in one pass.

Shapes chosen for scale:
* the 101-threshold cost curve is one pass: each row maps to the number of
  grid thresholds at or below its score, `groupBy` gives <= 102 rows, and
  cumulative sums run over those rows (no 101x scan, no cross join);
* PR/ROC curves and AUC group by distinct score, then use range-partitioned
  running totals (plans.prefix), never a window over a single task;
* selections (argmin cost, argmax F-beta) are `min_by`/`max_by` aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import COST_FN, COST_FP
from ..plans.prefix import running_totals
from ..plans.quantiles import exact_quantiles

GRID_STEPS = 100                          # thresholds i * 0.01, i = 0..100
BETAS = (1.0, 1.5, 2.0)
CALIBRATION_BINS = 10
HIST_BINS = 30
DECILE_PROBS = tuple(i * 0.1 for i in range(11))   # = numpy linspace(0, 1, 11)


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


# ---- F1 / F6 ----------------------------------------------------------------------

def confusion(df: DataFrame, threshold, group: list[str] = ()) -> DataFrame:
    """F1: tp, fp, fn, tn at `score >= threshold` (threshold: number or Column)."""
    pred = F.col("score") >= threshold
    y = F.col("label") == 1
    return df.groupBy(*group).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """precision, recall (sensitivity), specificity; 0 on empty denominators."""
    return {"precision": _safe_div(tp, tp + fp), "recall": _safe_div(tp, tp + fn),
            "specificity": _safe_div(tn, tn + fp)}


# ---- F2 / F3 ----------------------------------------------------------------------

def grid_count(score: Column, steps: int = GRID_STEPS) -> Column:
    """Number of thresholds i / steps (computed as i * (1/steps), exactly as a
    linspace grid) that are <= score, for i = 0..steps; clipped to 0..steps+1."""
    step = 1.0 / steps
    f = F.floor(score * steps)
    k = (F.when((f + 1) * F.lit(step) <= score, f + 2)
         .when(f * F.lit(step) > score, f)
         .otherwise(f + 1))
    return F.least(F.greatest(k, F.lit(0)), F.lit(steps + 1)).cast("int")


def cost_curve(df: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP,
               steps: int = GRID_STEPS) -> DataFrame:
    """threshold, tp, fp, fn, tn, cost for thresholds 0, .01, ..., 1.
    Predicted positive at threshold i iff grid_count(score) > i."""
    spark = df.sparkSession
    counts = (df.groupBy(grid_count(F.col("score"), steps).alias("k"))
              .agg(F.count_if(F.col("label") == 1).alias("pos"),
                   F.count_if(F.col("label") != 1).alias("neg")))
    grid = spark.range(0, steps + 2).select(F.col("id").cast("int").alias("k"))
    # <= steps + 2 rows on both sides: bounded, broadcast
    g = grid.join(F.broadcast(counts), "k", "left").fillna(0, ["pos", "neg"])
    desc = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    g = g.withColumns({"tp": F.sum("pos").over(desc), "fp": F.sum("neg").over(desc),
                       "P": F.sum("pos").over(everything), "N": F.sum("neg").over(everything)})
    step = 1.0 / steps
    return (g.filter(F.col("k") >= 1)
            .select(((F.col("k") - 1).cast("double") * F.lit(step)).alias("threshold"),
                    F.col("tp"), F.col("fp"), (F.col("P") - F.col("tp")).alias("fn"),
                    (F.col("N") - F.col("fp")).alias("tn"))
            .withColumn("cost", F.col("fn") * F.lit(float(cost_fn)) + F.col("fp") * F.lit(float(cost_fp))))


def best_threshold(curve: DataFrame) -> DataFrame:
    """first minimum (lowest threshold among equal costs)."""
    best = F.min_by(F.struct("threshold", "cost", "tp", "fp", "fn", "tn"),
                    F.struct("cost", "threshold"))
    return curve.agg(best.alias("b")).select("b.*")


def best_threshold_value(df: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> Column:
    """The grid-optimal threshold as a scalar sub-query (evaluated once)."""
    return best_threshold(cost_curve(df, cost_fn, cost_fp)).select("threshold").scalar()


# ---- F4 / F5 / F9 -----------------------------------------------------------------

def score_points(df: DataFrame, group: list[str] = (), ranges: int | None = None) -> DataFrame:
    """Per distinct score (desc): pos, neg at that score, tps/fps = positives
    and negatives with score >= it, and class totals P, N."""
    group = list(group)
    by_score = df.groupBy(*group, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    # class totals ride along from the range totals (no second pass)
    cum = running_totals(by_score, [F.col("score").desc()], ["pos", "neg"], group, ranges,
                         totals_prefix="_tot_")
    return cum.withColumnsRenamed({"cum_pos": "tps", "cum_neg": "fps",
                                   "_tot_pos": "P", "_tot_neg": "N"})


def pr_curve(df: DataFrame, group: list[str] = ()) -> DataFrame:
    """threshold (each distinct score), precision, recall."""
    pts = score_points(df, group)
    recall = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tps") / F.col("P"))
    return pts.select(*group, F.col("score").alias("threshold"),
                      _safe_div(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"),
                      recall.alias("recall"), "tps", "fps", "P", "N")


def fbeta(p: Column, r: Column, beta: float) -> Column:
    b2 = beta * beta
    return _safe_div((1 + b2) * p * r, b2 * p + r)


def fbeta_report(df: DataFrame, betas=BETAS, cost_fn: float = COST_FN,
                 cost_fp: float = COST_FP) -> DataFrame:
    """per beta, the PR point with the highest F (lowest threshold on
    ties): method, threshold, cost, recall, precision."""
    pr = pr_curve(df)
    pr = pr.withColumns({f"f{i}": fbeta(F.col("precision"), F.col("recall"), b)
                         for i, b in enumerate(betas)})
    pick = [F.max_by(F.struct("threshold", "precision", "recall", "tps", "fps", "P", "N"),
                     F.struct(F.col(f"f{i}"), -F.col("threshold"))).alias(f"b{i}")
            for i in range(len(betas))]
    one = pr.agg(*pick)
    rows = F.array(*[F.struct(F.lit(f"Beta {b}").alias("method"), F.col(f"b{i}").alias("p"))
                     for i, b in enumerate(betas)])
    out = one.select(F.inline(rows)).select("method", "p.*")
    fn, fp = F.col("P") - F.col("tps"), F.col("fps")
    return out.select("method", "threshold",
                      (fn * F.lit(float(cost_fn)) + fp * F.lit(float(cost_fp))).alias("cost"),
                      "recall", "precision")


def threshold_report(df: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """The cost comparison table (three F-beta rows and MIN COST)."""
    b = best_threshold(cost_curve(df, cost_fn, cost_fp))
    r = rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    mincost = b.select(F.lit("MIN COST").alias("method"), "threshold", "cost",
                       r["recall"].alias("recall"), r["precision"].alias("precision"))
    return fbeta_report(df, BETAS, cost_fn, cost_fp).unionByName(mincost)


def auc(df: DataFrame, group: list[str] = ()) -> DataFrame:
    """tie-aware ROC AUC (Mann-Whitney): sum over distinct scores of
    pos * (negatives below + negatives tied / 2) / (P * N); NULL when one
    class is absent."""
    pts = score_points(df, group)
    contrib = F.col("pos").cast("double") * (F.col("N") - F.col("fps") + F.col("neg") / 2.0)
    return (pts.groupBy(*group)
            .agg(F.sum(contrib).alias("_s"), F.first("P").alias("P"), F.first("N").alias("N"))
            .select(*group, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                   F.col("_s") / (F.col("P").cast("double") * F.col("N"))).alias("auc")))


def roc_curve(df: DataFrame, group: list[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the origin
    (threshold +inf, 0, 0) that a ROC curve starts from."""
    group = list(group)
    pts = score_points(df, group)
    curve = pts.select(*group, F.col("score").alias("threshold"),
                       _safe_div(F.col("fps"), F.col("N")).alias("fpr"),
                       _safe_div(F.col("tps"), F.col("P")).alias("tpr"))
    origin_cols = [F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                   F.lit(0.0).alias("tpr")]
    # one origin row per group (one row per group, or one in total)
    origin = (df.select(*group).distinct() if group else df.agg(F.count(F.lit(1)).alias("_n")))
    return curve.unionByName(origin.select(*group, *origin_cols))


# ---- F7 / F8 / F10 ----------------------------------------------------------------

def classification_report(counts: DataFrame) -> DataFrame:
    """F7 from one row of confusion counts: class rows 0 and 1, accuracy,
    macro avg, weighted avg (precision, recall, f1_score, support)."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1 = _safe_div(2 * p1 * r1, p1 + r1)
    f0 = _safe_div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = _safe_div(tp + tn, n)

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.alias("f1_score"),
                        s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None), F.lit(None), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
            _safe_div(f0 * s0 + f1 * s1, n), n))
    return counts.select(F.inline(rows))


def metrics_record(df: DataFrame, thr: float = 0.5, group: list[str] = ()) -> DataFrame:
    """F8 (F10 with a `model` group): auc, precision, recall, f1, thr,
    positives, n."""
    group = list(group)
    c = confusion(df, thr, group)
    r = rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    f1 = _safe_div(2 * r["precision"] * r["recall"], r["precision"] + r["recall"])
    base = c.select(*group, r["precision"].alias("precision"), r["recall"].alias("recall"),
                    f1.alias("f1"), F.lit(float(thr)).alias("thr"),
                    (F.col("tp") + F.col("fn")).alias("positives"),
                    (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"))
    a = auc(df, group)
    if group:
        return base.join(a, group, "left")
    return base.withColumn("auc", a.select("auc").scalar())


# ---- F11 / F12 / E10 / E11 --------------------------------------------------------

def calibration_curve(df: DataFrame, n_bins: int = CALIBRATION_BINS) -> DataFrame:
    """uniform bins; bin = number of inner edges i/n_bins below the
    score (right-closed bins, searchsorted-left semantics); empty bins drop."""
    step = 1.0 / n_bins
    b = None
    for i in range(1, n_bins):
        t = (F.lit(i * step) < F.col("score")).cast("int")
        b = t if b is None else b + t
    return (df.groupBy(b.alias("bin"))
            .agg(F.avg(F.col("label").cast("double")).alias("prob_true"),
                 F.avg("score").alias("prob_pred"), F.count(F.lit(1)).alias("n")))


def score_histogram(df: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """equal-width bins between min and max score, per label."""
    lo = df.agg(F.min("score")).scalar()
    hi = df.agg(F.max("score")).scalar()
    width = hi - lo
    raw = F.floor((F.col("score") - lo) * F.lit(bins) / width)
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    return (df.groupBy(b.alias("bin"), "label")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumns({"bin_lo": lo + F.col("bin") * width / bins,
                          "bin_hi": lo + (F.col("bin") + 1) * width / bins}))


def decile_edges(df: DataFrame) -> Column:
    """E10 edges: distinct exact quantiles at 0, .1, ..., 1."""
    q = exact_quantiles(df, F.col("score"), DECILE_PROBS)
    return q.select(F.array_distinct("q").alias("e")).scalar()


def with_decile(df: DataFrame) -> DataFrame:
    """qcut(score, 10, duplicates='drop'): bin i holds (e_i, e_i+1],
    the lowest edge included in bin 0."""
    edges = decile_edges(df)
    # at most 11 edges: count those below the score (missing ones count 0)
    below = None
    for i in range(len(DECILE_PROBS)):
        t = F.coalesce((F.get(edges, i) < F.col("score")).cast("int"), F.lit(0))
        below = t if below is None else below + t
    return df.withColumn("decile", F.greatest(below - 1, F.lit(0)).cast("int"))


def decile_stats(df: DataFrame) -> DataFrame:
    """Mean actual and mean predicted per decile."""
    return (with_decile(df).groupBy("decile")
            .agg(F.avg(F.col("label").cast("double")).alias("actual"),
                 F.avg("score").alias("pred")))


# ---- D8 / D16 / D18 ---------------------------------------------------------------

def cost_kpis(df: DataFrame, cost_fn: float = COST_FN, cost_fp: float = COST_FP,
              value_col: str = "MonthlyCharges") -> DataFrame:
    """Best threshold, min cost, do-nothing cost, savings, monthly
    revenue at risk (sum of value over rows at or above the threshold)."""
    b = best_threshold(cost_curve(df, cost_fn, cost_fp))
    thr = b.select("threshold").scalar()
    min_cost = b.select("cost").scalar()
    agg = df.agg(F.count_if(F.col("label") == 1).alias("churners"),
                 F.sum(F.when(F.col("score") >= thr, F.col(value_col))).alias("rev"))
    return agg.select(
        thr.alias("best_threshold"), min_cost.alias("min_cost"),
        (F.col("churners") * F.lit(float(cost_fn))).alias("do_nothing_cost"),
        (F.col("churners") * F.lit(float(cost_fn)) - min_cost).alias("savings"),
        F.coalesce(F.col("rev"), F.lit(0.0)).alias("revenue_at_risk"))


def class_weight(df: DataFrame, label: str = "label", guard: bool = True) -> DataFrame:
    """n0, n1, pos_weight = n0 / max(n1, 1) (v1: n0 / n1)."""
    n0 = F.count_if(F.col(label) == 0)
    n1 = F.count_if(F.col(label) == 1)
    den = F.greatest(n1, F.lit(1)) if guard else n1
    return df.agg(n0.alias("n0"), n1.alias("n1"), (n0 / den).alias("pos_weight"))


def window_summary(df: DataFrame) -> DataFrame:
    """Per model/window: average predicted risk and positives."""
    return df.groupBy("model").agg(F.avg("score").alias("avg_pred_risk"),
                                   F.sum("label").cast("bigint").alias("positives_in_test"))


# ---- J7 / A7: metrics as one JSON document ----------------------------------------

METRIC_FIELDS = ("auc", "precision", "recall", "f1", "thr", "positives", "n")


def metrics_document(records: DataFrame, key: str = "model") -> DataFrame:
    """One JSON object keyed by model ({"churn_model": {...}, ...}); the
    collected list holds one entry per model (bounded by the model list)."""
    entry = F.struct(F.col(key), F.struct(*[F.col(c) for c in METRIC_FIELDS]))
    return records.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("document"))


def parse_metrics_document(doc: DataFrame, key: str = "model") -> DataFrame:
    """J7 decode: the document back to one row per model."""
    schema = ("map<string, struct<auc: double, precision: double, recall: double, f1: double, "
              "thr: double, positives: bigint, n: bigint>>")
    return (doc.select(F.explode(F.from_json("document", schema)).alias(key, "m"))
            .select(key, "m.*"))
