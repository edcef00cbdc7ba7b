"""Benchmark the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each step is forced with the `noop` sink (full computation, no collect).
One untimed warm-up pass over the smallest tables ($BENCH_WARMUP_DIR,
default sf0.001) runs first so JVM start-up and code compilation are not
charged to the first query; its duration is reported as `warmup_sec`.
Shuffle bytes written per step (`shuffle_bytes`) come from Spark's event log,
written to a fresh scratch folder; each step's jobs carry the step's job group.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from retentio.config import LiveParams  # noqa: E402
from retentio.operators import evaluate as Ev  # noqa: E402
from retentio.operators import policy as P  # noqa: E402
from retentio.operators import profile as D  # noqa: E402
from retentio.plans import jobs as J  # noqa: E402
from retentio.plans import tables as T  # noqa: E402
from retentio.session import local_session  # noqa: E402
from retentio.sources import fixture  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def event_stats(event_dir: str) -> tuple[dict[str, int], dict[str, int]]:
    """Shuffle bytes written and number of jobs per job group, from an
    uncompressed event log."""
    group_of_job, job_of_stage, out, jobs = {}, {}, {}, {}
    for path in sorted(glob.glob(os.path.join(event_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path, errors="ignore") as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    group_of_job[e["Job ID"]] = g
                    if g:
                        jobs[g] = jobs.get(g, 0) + 1
                    for sid in e.get("Stage IDs", []):
                        job_of_stage[sid] = e["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    g = group_of_job.get(job_of_stage.get(e.get("Stage ID")))
                    m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if g:
                        out[g] = out.get(g, 0) + int(m.get("Shuffle Bytes Written", 0))
    return out, jobs


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    events = tempfile.mkdtemp(prefix="retentio-bench-events-", dir="/tmp")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", cpus)),
                          app="retentio-bench",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": events,
                                 "spark.eventLog.compress": "false"})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warmup = 0.0
    if warm_dir and os.path.isdir(warm_dir):
        t = time.perf_counter()
        steps(spark, warm_dir, {}, "warmup:")
        warmup = round(time.perf_counter() - t, 3)
    times: dict[str, float] = {}
    steps(spark, sf_dir, times)
    total = round(sum(times.values()), 3)
    spark.stop()                                    # flushes the event log
    shuffled, jobs = event_stats(events)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "cpus": cpus, "warmup_sec": warmup,
                      "shuffle_bytes": {k: shuffled.get(k, 0) for k in times},
                      "jobs": {k: jobs.get(k, 0) for k in times}}))


def steps(spark, sf_dir: str, times: dict, group_prefix: str = "") -> None:

    def timed(name, fn):
        spark.sparkContext.setJobGroup(group_prefix + name, name)
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    spark.range(1).count()          # session start-up is not query time
    raw = fixture.subscribers(spark, sf_dir)
    # the engineered table is a stage boundary, written once as upstream
    lab = timed("engineer_label", lambda: T.materialize(J.labeled(raw), "bench_engineered"))
    model = timed("fit_scorecards", lambda: J.fit_models(lab))
    everyone = timed("score_all", lambda: T.bucketed(
        J.scored(lab, model, test_only=False), "bench_scored"))
    timed("decision_table", lambda: run(J.decision_table(everyone)))
    hold = everyone.filter(F.col("is_test"))
    ev = hold.select(F.col("Churn_Target").alias("label"), F.col("churn_prob").alias("score"),
                     "MonthlyCharges")
    timed("threshold_sweep", lambda: (run(Ev.cost_curve(ev)), run(Ev.threshold_report(ev)),
                                      run(Ev.cost_kpis(ev))))
    pairs = (("churn_model", "Churn_Target", "churn_prob"), ("timing_30d", "y_30d", "risk_30d"),
             ("timing_60d", "y_60d", "risk_60d"), ("timing_90d", "y_90d", "risk_90d"))
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(l).cast("int").alias("label"),
                             F.col(s).alias("score")) for m, l, s in pairs])
    evm = hold.select(F.inline(arr))
    timed("model_metrics_auc", lambda: run(Ev.metrics_record(evm, 0.5, ["model"])))
    eng = lab
    timed("eda_unpivot", lambda: (run(D.churn_rate_by_category(eng)),
                                  run(D.correlation_matrix(eng)),
                                  run(D.distribution_by_label(eng))))

    def live():
        results = hold.select("customerID", "tenure", "MonthlyCharges", "TotalCharges", "Contract",
                              "PaymentMethod", "InternetService",
                              F.col("churn_prob").alias("Churn_Prob"))
        dec = T.bucketed(J.decision_table(hold), "bench_decisions")
        thr = Ev.best_threshold_value(ev)
        # the working table is computed once and read by every output
        view = T.materialize(P.live_view(results, dec, thr, LiveParams()), "bench_live")
        run(P.live_kpis(view))
        run(P.action_list(view, 500))

    timed("live_routing", live)


if __name__ == "__main__":
    main()
