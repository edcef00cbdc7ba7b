"""End to end on the driver tables: invariants and plan shape."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from retentio.config import LiveParams
from retentio.operators import evaluate as Ev
from retentio.plans import jobs as J
from retentio.sources import fixture

from .conftest import SF_CHECK, SF_SMALL


def test_fixture_counts(spark):
    sub = fixture.subscribers(spark, SF_CHECK)
    agg = sub.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("tenure").isin(-1.0, 130.0)).alias("sanity"),
                  F.count_if(F.col("tenure").isNull()).alias("null_tenure"),
                  F.count_if(F.col("MonthlyCharges") < 0).alias("neg"),
                  F.count_if(F.col("TotalCharges") == " ").alias("blank"),
                  F.count_if(F.col("PaymentMethod").isNull()).alias("null_pay"),
                  F.count_if(F.col("Churn") == "Yes").alias("churners"),
                  *[F.count_if(F.col("days_to_churn") <= w).alias(f"p{w}") for w in (30, 60, 90)]).first()
    assert agg.asDict() == {"n": 1500, "sanity": 29, "null_tenure": 4, "neg": 122, "blank": 20,
                            "null_pay": 17, "churners": 322, "p30": 175, "p60": 198, "p90": 231}


def test_split_size(spark):
    lab = J.labeled(fixture.subscribers(spark, SF_CHECK))
    assert lab.filter("is_test").count() == 287


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "should_intervene" in df.columns


def test_contributions_add_up(spark):
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    model = J.fit_models(lab)
    sc = J.scored(lab, model)
    base = model.base["Churn_Target"]
    out = sc.select("churn_prob", F.aggregate("contribs", F.lit(0.0),
                                              lambda a, x: a + x["contrib"]).alias("s")).collect()
    import math
    for r in out:
        assert 1 / (1 + math.exp(-(base + r["s"]))) == pytest.approx(r["churn_prob"], abs=1e-12)


def test_invariants_and_routing(spark):
    lab = J.labeled(fixture.subscribers(spark, SF_CHECK))
    sc = J.scored(lab, J.fit_models(lab))
    ev = sc.select(F.col("Churn_Target").alias("label"), F.col("churn_prob").alias("score"))
    curve = {round(r["threshold"], 2): r for r in Ev.cost_curve(ev).collect()}
    n = ev.count()
    neg = ev.filter("label = 0").count()
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == n for r in curve.values())
    assert curve[0.0]["cost"] == neg * 50.0
    from retentio.operators import policy as P
    results = sc.select("customerID", "tenure", "MonthlyCharges", "Contract",
                        F.col("churn_prob").alias("Churn_Prob"))
    dec = J.decision_table(sc)
    view = P.live_view(results, dec, Ev.best_threshold_value(ev), LiveParams(calls_per_week=25))
    tiers = {r[0]: r[1] for r in view.groupBy("routing_tier_live").count().collect()}
    assert tiers.get("🔴 Critical Risk", 0) <= 25
    assert view.filter(F.col("routing_tier_live").isNull()).count() == 0


def test_plans_stay_in_jvm(spark):
    """No Python UDF in the hot path, no single-task window on row data."""
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    sc = J.scored(lab, J.fit_models(lab))
    plan = J.decision_table(sc)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    ev = sc.select(F.col("Churn_Target").alias("label"), F.col("churn_prob").alias("score"))
    pr_plan = Ev.pr_curve(ev)._jdf.queryExecution().executedPlan().toString()
    # running sums read the written range-id table and window per range
    import re
    assert "/ranges-" in pr_plan
    assert re.search(r"windowspecdefinition\(_r#", pr_plan)


def test_sampled_shapley_efficiency(spark):
    """Per customer the contributions add up to the mean over chains of
    margin(x) - margin(background row)."""
    import math
    from retentio.operators import models as ML
    from retentio.operators import shapley as SH
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    train, test = lab.filter(~F.col("is_test")), lab.filter(F.col("is_test"))
    m = ML.fit_churn_model(train, params=dict(maxIter=5, maxDepth=3))
    long = SH.sampled_shapley(m, test, train, permutations=4, background_rows=16)
    sums = {r[0]: r[1] for r in long.groupBy("customerID").agg(F.sum("contribution")).collect()}
    feats = m.numeric + m.categorical
    assert long.count() == test.count() * len(feats)
    # margin(x) - E_chains[margin(z)]: recompute the chain background rows
    px = {r["customerID"]: r["churn_prob"] for r in m.transform(test).select("customerID", "churn_prob").collect()}
    bg = SH.background_sample(train, feats, 16)
    pz = {r["_b"]: r["churn_prob"] for r in m.transform(bg).select("_b", "churn_prob").collect()}
    n_bg = len(pz)
    chains = (test.select("customerID").withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(3))))
              .withColumn("_b", F.pmod(F.xxhash64(F.lit(42), F.col("customerID"), F.col("_m")),
                                       F.lit(n_bg)).cast("int")).collect())
    logit = lambda p: math.log(max(min(p, 1 - 1e-12), 1e-12) / (1 - max(min(p, 1 - 1e-12), 1e-12)))
    want = {}
    for r in chains:
        want.setdefault(r["customerID"], []).append(logit(px[r["customerID"]]) - logit(pz[r["_b"]]))
    for cid, vals in want.items():
        assert sums[cid] == pytest.approx(sum(vals) / len(vals), abs=1e-9)


def test_jobs_build_all_and_config(spark, tmp_path):
    import os
    from retentio import jobs
    from retentio.config import RetentionPolicy
    from retentio.sources import tables as SRC
    cfg = os.path.join(os.path.dirname(jobs.__file__), "resources", "retention_policy.json")
    policy = RetentionPolicy.from_dict(SRC.load_config(spark, cfg))
    assert policy == RetentionPolicy()
    paths = jobs.build_all(spark, str(tmp_path / "out"), SF_SMALL, policy=policy)
    dec = spark.read.parquet(paths["decision_table"])
    assert dec.count() == spark.read.parquet(paths["scored_holdout"]).count()
    assert spark.read.json(paths["model_metrics"] + "_json").count() == 4


def test_salted_lookup_path_equals_broadcast(spark):
    """Above the broadcast limit the scorecard lookups go through salted
    shuffle joins; results must not change."""
    from pyspark.sql.functions import round as fround
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    model = J.fit_models(lab)
    a = J.scored(lab, model).select("customerID", fround("churn_prob", 12).alias("p"),
                                    fround("risk_90d", 12).alias("r"))
    model.max_broadcast_rows = 0
    salted = J.scored(lab, model)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    b = salted.select("customerID", fround("churn_prob", 12).alias("p"), fround("risk_90d", 12).alias("r"))
    assert sorted(a.collect()) == sorted(b.collect())
    assert b.count() == lab.filter("is_test").count()


def test_bucketed_merge_has_no_shuffle(spark):
    """Scored rows and the decision table are bucketed by customerID, so the
    C1 merge is a sort-merge join without an Exchange on either side."""
    from retentio import catalog as K
    from retentio.operators import policy as P
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = P.merge_suffixed(K.results_v1(spark, SF_SMALL), K.decisions(spark, SF_SMALL))
        plan = m._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert m.count() == K.scored(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_jobs_whole_population(spark, tmp_path):
    from retentio import jobs
    paths = jobs.build_all(spark, str(tmp_path / "all"), SF_SMALL)
    n = fixture.subscribers(spark, SF_SMALL).count()
    assert spark.read.parquet(paths["decision_table_all"]).count() == n


def test_gbt_encoding_unseen_category_and_names(spark):
    """An unseen category encodes to zeros (scoring works), NULL is its
    own category, and encoded names line up with the feature vector."""
    from retentio.operators import models as ML
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    train = lab.filter(~F.col("is_test"))
    m = ML.fit_churn_model(train, params=dict(maxIter=3, maxDepth=2))
    names = m.feature_names()
    assert len(names) == m.gbt.numFeatures
    odd = lab.filter(F.col("is_test")).limit(3).withColumn("Contract", F.lit("Ten year"))
    enc = odd.withColumn("features", m.encoding.column())
    idx = [i for i, n in enumerate(names) if n.startswith("cat__Contract_")]
    vals = [r[0] for r in enc.select("features").collect()]
    assert all(all(v[i] == 0.0 for i in idx) for v in vals)
    assert m.transform(odd).filter(F.col("churn_prob").isNull()).count() == 0


def test_entry_schema_is_stable(spark):
    a = E.entry(spark)
    b = E.entry(spark)
    assert a.schema == b.schema
    assert a.count() == b.count() == fixture.subscribers(spark, SF_SMALL).count()


def test_lookup_join_counts_and_salts_hot_keys(spark):
    """The small side is counted when its size is not given; above the limit
    the join is salted, and a key holding most rows still joins exactly."""
    from retentio.plans.lookup import lookup_join
    big = spark.range(0, 3000).select(F.col("id").cast("string").alias("customerID"),
                                      F.when(F.col("id") < 2000, "hot").otherwise(
                                          (F.col("id") % 7).cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", 1.0)] + [(str(i), float(i)) for i in range(7)],
                                  "k string, w double")
    b = lookup_join(big, small, "k", "left")
    s = lookup_join(big, small, "k", "left", max_broadcast_rows=0, salts=16)
    assert "_salt" in s._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in b._jdf.queryExecution().executedPlan().toString()
    assert sorted(b.collect()) == sorted(s.select(*b.columns).collect())
    assert s.filter(F.col("k") == "hot").count() == 2000


def test_sampled_shapley_is_deterministic(spark):
    """Chains come from hashes of (seed, key, permutation): a second run (or a
    recomputed task) yields the same contributions."""
    from retentio.operators import models as ML
    from retentio.operators import shapley as SH
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    train, test = lab.filter(~F.col("is_test")), lab.filter(F.col("is_test"))
    m = ML.fit_churn_model(train, params=dict(maxIter=3, maxDepth=2))

    def run():
        long = SH.sampled_shapley(m, test, train, permutations=3, background_rows=8)
        return sorted((r[0], r[1], round(r[2], 12)) for r in long.collect())

    assert run() == run()


def test_sampled_shapley_draws_from_all_training_rows(spark):
    """Without a limit each chain joins one position of the whole training
    set, and a customer's contributions add up to the mean over its chains."""
    import math
    from retentio.operators import models as ML
    from retentio.operators import shapley as SH
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    train, test = lab.filter(~F.col("is_test")), lab.filter(F.col("is_test"))
    m = ML.fit_churn_model(train, params=dict(maxIter=3, maxDepth=3))
    long = SH.sampled_shapley(m, test, train, permutations=3)
    sums = {r[0]: r[1] for r in long.groupBy("customerID").agg(F.sum("contribution")).collect()}
    assert long.filter("std_error IS NULL OR std_error < 0").count() == 0
    margin = lambda p: math.log(min(max(p, 1e-12), 1 - 1e-12) / (1 - min(max(p, 1e-12), 1 - 1e-12)))
    p_of = lambda df: {r[0]: margin(r[1]) for r in m.transform(df).select("customerID", "churn_prob").collect()}
    px, pz = p_of(test), p_of(train)
    order = [r[0] for r in train.select("customerID").orderBy("customerID").collect()]
    picks = (test.select("customerID", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("_m"))
             .withColumn("_b", F.pmod(F.xxhash64(F.lit(42), "customerID", "_m"), F.lit(len(order)))).collect())
    want = {}
    for r in picks:
        want.setdefault(r["customerID"], []).append(px[r["customerID"]] - pz[order[r["_b"]]])
    assert sums.keys() == want.keys()
    for key, values in want.items():
        assert sums[key] == pytest.approx(sum(values) / len(values), abs=1e-9)


def test_scorecard_lookup_paths_agree(spark, monkeypatch):
    """Literal weights and broadcast look-ups give the same scores."""
    from retentio.operators import scorecard as SC
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    model = J.fit_models(lab)
    assert len(model.features) == 20
    read = lambda: {r[0]: r[1] for r in J.scored(lab, model).select("customerID", "churn_prob").collect()}
    literal = read()
    monkeypatch.setattr(SC, "MAX_LITERAL_VALUES", 0)
    joined = read()
    assert literal.keys() == joined.keys()
    assert all(literal[k] == pytest.approx(joined[k], abs=1e-12) for k in literal)


def test_saved_model_loads_from_its_path_alone(spark, tmp_path):
    """Columns, medians and label come with the saved model."""
    from retentio.operators import models as ML
    lab = J.labeled(fixture.subscribers(spark, SF_SMALL))
    m = ML.fit_churn_model(lab.filter(~F.col("is_test")), "y_30d",
                           params=dict(maxIter=2, maxDepth=2))
    m.save(f"{tmp_path}/model/")
    loaded = ML.load_churn_model(f"{tmp_path}/model")
    assert (loaded.numeric, loaded.categorical, loaded.fill, loaded.label) == (
        m.numeric, m.categorical, m.fill, "y_30d")
    assert loaded.feature_names() == m.feature_names()
    rows = [x.transform(lab).select("customerID", "churn_prob") for x in (m, loaded)]
    assert sorted(rows[0].collect()) == sorted(rows[1].collect())
    m.save(f"{tmp_path}/model")                 # overwrites
