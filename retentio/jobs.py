"""Batch entry point: build every table of the retention workflow.

    python -m retentio.jobs --sf-dir /path/to/tables --out /shared/retention
        [--raw-csv folder] [--model scorecard|gbt]

Stages (each writes Parquet under --out, metrics also as JSON):
engineered, scorecard_model or models/ with gbt_nodes and
feature_importance, scored_holdout, reason_codes, decision_table,
scored_all, decision_table_all (every customer), cost_curve,
threshold_report, classification_report, pr_curve, roc_curve, calibration,
score_histogram, deciles, model_metrics, global_drivers, eda_*, and the
live tables (live_view, live_kpis, live_segments, action_list,
critical_queue, target_queue). A raw CSV also leaves `quarantine`, its
malformed lines. Both models make the same tables.
On a cluster the session comes from spark-submit; --out must be shared storage.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import LiveParams, RetentionPolicy
from .operators import evaluate as Ev
from .operators import explain as X
from .operators import model_store
from .operators import policy as P
from .operators import profile as D
from .plans import jobs as J
from .plans import tables as T
from .session import ensure_checkpoint_dir
from .sources import fixture, tables as SRC

MODEL_PAIRS = (("churn_model", "Churn_Target", "churn_prob"), ("timing_30d", "y_30d", "risk_30d"),
               ("timing_60d", "y_60d", "risk_60d"), ("timing_90d", "y_90d", "risk_90d"))


def build_all(spark: SparkSession, out: str, sf_dir: str | None = None, raw_csv: str | None = None,
              policy: RetentionPolicy = RetentionPolicy(), model: str = "scorecard",
              gbt_params: dict | None = None, live: LiveParams = LiveParams()) -> dict[str, str]:
    if model not in ("scorecard", "gbt"):
        raise ValueError("model must be 'scorecard' or 'gbt'")
    ensure_checkpoint_dir(spark)
    paths = {}

    def save(name, df, json=False, bucket_key=None):
        p = f"{out.rstrip('/')}/{name}"
        if bucket_key:
            T.bucketed(df, name, bucket_key, path=p)       # co-located joins on the key
        else:
            T.write_table(df, p)
        if json:
            T.write_json(spark.read.parquet(p), p + "_json")
        paths[name] = p
        return spark.read.parquet(p)

    if raw_csv:
        got = SRC.ingest_raw(spark, raw_csv, f"{out.rstrip('/')}/ingested")
        save("quarantine", got.quarantine)
        raw = got.rows
    else:
        raw = fixture.subscribers(spark, sf_dir)
    lab = save("engineered", J.labeled(raw))
    if model == "gbt":
        fitted = model_store.fit_or_load(f"{out.rstrip('/')}/models", lab, gbt_params)
        paths["models"] = fitted.path
        churn = fitted.models[J.CHURN_LABEL]
        save("gbt_nodes", churn.nodes())
        save("feature_importance", churn.feature_importance(spark))
        score = fitted.scored
    else:
        card = J.fit_models(lab)
        save("scorecard_model", card.table)
        score = lambda rows, test_only=True: J.scored(rows, card, test_only)
    scored = save("scored_holdout", score(lab), bucket_key="customerID")
    save("reason_codes", J.reason_code_table(scored))
    decisions = save("decision_table", J.decision_table(scored, policy), bucket_key="customerID")
    everyone = save("scored_all", score(lab, test_only=False), bucket_key="customerID")
    save("decision_table_all", J.decision_table(everyone, policy), bucket_key="customerID")
    ev = scored.select(F.col("Churn_Target").alias("label"), F.col("churn_prob").alias("score"),
                       "MonthlyCharges")
    curve = save("cost_curve", Ev.cost_curve(ev))
    save("threshold_report", Ev.threshold_report(ev))
    # the curve is a written table of 101 rows: the best point is read once
    threshold = F.lit(Ev.best_threshold(curve).first()["threshold"])
    save("classification_report", Ev.classification_report(Ev.confusion(ev, threshold)))
    save("pr_curve", Ev.pr_curve(ev))
    save("roc_curve", Ev.roc_curve(ev))
    save("calibration", Ev.calibration_curve(ev))
    save("score_histogram", Ev.score_histogram(ev))
    save("deciles", Ev.decile_stats(ev))
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(l).cast("int").alias("label"),
                             F.col(s).alias("score")) for m, l, s in MODEL_PAIRS if l in scored.columns])
    save("model_metrics", Ev.metrics_record(scored.select(F.inline(arr)), 0.5, ["model"]), json=True)
    save("global_drivers", X.global_drivers(scored))
    save("eda_churn_rate", D.churn_rate_by_category(lab))
    save("eda_correlation", D.correlation_matrix(lab))
    save("eda_distribution", D.distribution_by_label(lab))
    save("eda_tenure_bucket", D.churn_by_tenure_bucket(lab))
    save("eda_top_categories", D.top_categories(lab))
    if "expected_loss_30d" in decisions.columns:
        results = scored.select("customerID", *[c for c in J.CONTEXT_COLUMNS if c in scored.columns],
                                F.col("churn_prob").alias("Churn_Prob"))
        view = save("live_view", P.live_view(results, decisions, threshold, live))
        save("live_kpis", P.live_kpis(view))
        save("live_segments", P.value_counts(view, "Segment"))
        save("action_list", P.action_list(view, position="position").select(
            *[c for c in P.ACTION_LIST_COLUMNS if c in view.columns or c == "position"]))
        save("critical_queue", P.queue(view, "🔴 Critical Risk", position="position"))
        save("target_queue", P.queue(view, "🟡 Target Zone", position="position"))
    return paths


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf-dir", help="folder with customer.parquet and orders.parquet")
    ap.add_argument("--raw-csv", help="folder holding a raw subscriber CSV instead")
    ap.add_argument("--config", help="policy JSON (margin, horizon, costs, weights, cuts)")
    ap.add_argument("--model", choices=("scorecard", "gbt"), default="scorecard")
    ap.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("retentio-jobs").getOrCreate()
    policy = (RetentionPolicy.from_dict(SRC.load_config(spark, a.config)) if a.config
              else RetentionPolicy())
    for name, path in build_all(spark, a.out, a.sf_dir, a.raw_csv, policy,
                                a.model).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
