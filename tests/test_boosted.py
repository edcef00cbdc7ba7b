"""Bounded encoding, the fit matrix, node and leaf tables, exact Shapley
values, model folders and the batch job with boosted trees."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from retentio import jobs
from retentio.operators import encoding as EN
from retentio.operators import model_store
from retentio.operators import models as ML
from retentio.operators import trees as TR
from retentio.plans import jobs as J
from retentio.plans.manifest import fingerprint, read_manifest
from retentio.plans.tables import ensure_table, materialize, scratch_path
from retentio.sources import fixture

from .conftest import SF_SMALL

SMALL = dict(maxIter=4, maxDepth=3)


@pytest.fixture(scope="module")
def lab(spark):
    return materialize(J.labeled(fixture.subscribers(spark, SF_SMALL)), "lab")


@pytest.fixture(scope="module")
def model(lab):
    return ML.fit_churn_model(lab.filter(~F.col("is_test")), params=SMALL)


def test_an_id_column_is_hashed_and_fits(spark):
    rows = spark.range(600).select(
        F.concat(F.lit("user-"), "id").alias("handle"), (F.col("id") % 3).cast("string").alias("kind"),
        F.when(F.col("id") % 5 != 0, F.col("id").cast("double")).alias("x"),
        (F.col("id") % 2).cast("int").alias("Churn_Target"))
    enc = EN.plan_encoding(rows, ["Churn_Target"], max_values=50, hash_slots=16)
    assert enc.text == {"handle": 16, "kind": ["0", "1", "2"]}
    assert len(enc.names()) == 1 + 16 + 3
    m = ML.fit_models(rows, ["Churn_Target"], SMALL, ["Churn_Target"], enc)["Churn_Target"]
    new = rows.withColumn("handle", F.lit("never seen")).withColumn("kind", F.lit(None).cast("string"))
    assert m.transform(new).filter(F.col("churn_prob").between(0, 1)).count() == 600
    path = scratch_path(spark, "hashed")
    m.save(path)
    again = ML.load_churn_model(path)
    assert again.encoding == enc
    table = {r["name"]: r["kind"] for r in spark.read.parquet(f"{path}/inputs").collect()}
    assert table == {"x": "numeric", "handle": "hashed", "kind": "dictionary"}


def test_the_dictionary_bound_is_exact(spark):
    rows = spark.range(300).select((F.col("id") % 20).cast("string").alias("c"))
    assert len(EN.plan_encoding(rows, [], max_values=20).text["c"]) == 20
    assert EN.plan_encoding(rows, [], max_values=19, hash_slots=8).text["c"] == 8


def test_bins_follow_the_cuts(spark):
    enc = EN.Encoding(["v"], {"v": 2.0}, {"v": [1.0, 2.0, 5.0]}, {})
    rows = spark.createDataFrame([(x,) for x in (0.5, 1.0, 1.5, 5.0, 9.0, None, float("nan"))], "v double")
    assert [r[0][0] for r in rows.select(enc.column()).collect()] == [0, 0, 1, 2, 3, 1, 1]


def test_all_models_read_the_matrix_only(lab, spark):
    enc = EN.plan_encoding(lab)
    matrix = EN.build_matrix(lab, enc, ["Churn_Target", "y_30d"])
    plan = EN.with_features(matrix)._jdf.queryExecution().executedPlan().toString()
    assert "matrix-" in plan and "Join" not in plan and "orders" not in plan
    models = ML.fit_models(None, ["Churn_Target", "y_30d"], SMALL, encoding=enc, matrix=matrix)
    assert models["y_30d"].encoding is models["Churn_Target"].encoding


def test_scores_from_leaves_equal_the_model(lab, model):
    rows = EN.build_matrix(lab, model.encoding, ["customerID"])
    margins = {r[0]: r[1] for r in TR.leaf_scores(rows, model.leaves()).collect()}
    for r in model.transform(lab).select("customerID", "churn_prob").collect():
        assert 1 / (1 + math.exp(-margins[r[0]])) == pytest.approx(r[1], abs=1e-12)


def test_node_table_walks_raw_values(lab, model):
    """The trees read as rows decide raw values as the model does."""
    nodes = {(r["tree"], r["node"]): r for r in model.nodes().collect()}
    names = model.feature_names()
    for row in model.transform(lab).limit(40).collect():
        margin = 0.0
        for tree in {t for t, _ in nodes}:
            n = nodes[tree, 0]
            while n["left"] >= 0:
                kind, _, name = names[n["feature"]].partition("__")
                if kind == "num":
                    v = row[name] if row[name] is not None else model.encoding.fill[name]
                    left = v <= n["raw_cut"]
                else:
                    column = next(c for c in model.categorical if name.startswith(c + "_"))
                    v = row[column] if row[column] is not None else "nan"
                    left = name != f"{column}_{v}"
                n = nodes[tree, n["left"] if left else n["right"]]
            margin += n["value"]
        assert 1 / (1 + math.exp(-margin)) == pytest.approx(row["churn_prob"], abs=1e-12)


def brute_shapley(nodes, x, n):
    """Shapley values by full enumeration of the path-dependent game."""
    def value(tree, node, known):
        r = nodes[tree, node]
        if r["left"] < 0:
            return r["value"]
        if r["feature"] in known:
            return value(tree, r["left"] if x[r["feature"]] <= r["cut"] else r["right"], known)
        return sum(nodes[tree, c]["cover"] / r["cover"] * value(tree, c, known)
                   for c in (r["left"], r["right"]))

    def game(known):
        return sum(value(t, 0, known) for t in {t for t, _ in nodes})

    out = []
    for j in range(n):
        rest = [k for k in range(n) if k != j]
        out.append(sum(math.factorial(s) * math.factorial(n - 1 - s) / math.factorial(n)
                       * (game({*known, j}) - game(set(known)))
                       for s in range(n) for known in itertools.combinations(rest, s)))
    return out, game(set())


def test_shapley_equals_full_enumeration(spark):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("customerID"),
        *[(F.pmod(F.hash("id", F.lit(i)), F.lit(9))).cast("double").alias(f"f{i}") for i in range(4)])
    rows = rows.withColumn("Churn_Target", ((F.col("f0") > 4) & (F.col("f1") < 6) | (F.col("f2") * F.col("f3") > 30)).cast("int"))
    m = ML.fit_models(rows, ["Churn_Target"], dict(maxIter=5, maxDepth=4), ["customerID", "Churn_Target"])["Churn_Target"]
    nodes = {(r["tree"], r["node"]): r for r in m.nodes().collect()}
    matrix = EN.build_matrix(rows.limit(12), m.encoding, ["customerID"])
    got = {}
    for r in TR.tree_shapley(matrix, m.leaves(), m.feature_names()).collect():
        got[r["customerID"], r["feature"]] = r["contribution"]
    base = TR.base_value(m.leaves()).first()["base"]
    for row in matrix.collect():
        want, empty = brute_shapley(nodes, row["x"], 4)
        assert empty == pytest.approx(base)
        for j, v in enumerate(want):
            assert got.get((row["customerID"], f"num__f{j}"), 0.0) == pytest.approx(v, abs=1e-9)


def test_a_tree_that_is_one_leaf(spark):
    rows = spark.range(20).select(F.col("id").cast("string").alias("customerID"), F.lit(1.0).alias("f"),
                                  (F.col("id") % 2).cast("int").alias("Churn_Target"))
    m = ML.fit_models(rows, ["Churn_Target"], dict(maxIter=2, maxDepth=2), ["customerID", "Churn_Target"])["Churn_Target"]
    matrix = EN.build_matrix(rows, m.encoding, ["customerID"])
    assert TR.leaf_scores(matrix, m.leaves()).count() == 20
    assert TR.tree_shapley(matrix, m.leaves(), m.feature_names()).count() == 0


def test_model_folder_is_fitted_once(spark, lab, tmp_path):
    first = model_store.fit_or_load(str(tmp_path), lab, SMALL)
    again = model_store.fit_or_load(str(tmp_path), lab, SMALL)
    assert first.fitted and not again.fitted and first.path == again.path
    assert read_manifest(spark, first.path)["labels"] == ["Churn_Target", "y_30d", "y_60d", "y_90d"]
    a, b = (m.scored(lab, contributions=False).select("customerID", "churn_prob", "risk_90d")
            for m in (first, again))
    assert sorted(a.collect()) == sorted(b.collect())
    changed = materialize(lab.withColumn("MonthlyCharges", F.col("MonthlyCharges") + 1), "lab")
    other = model_store.fit_or_load(str(tmp_path), changed, SMALL)
    assert other.fitted and other.path != first.path


def test_batch_job_makes_the_same_tables_from_both_models(spark, tmp_path):
    made = {m: jobs.build_all(spark, f"{tmp_path}/{m}", SF_SMALL, model=m, gbt_params=SMALL)
            for m in ("scorecard", "gbt")}
    own = {"scorecard": {"scorecard_model"}, "gbt": {"models", "gbt_nodes", "feature_importance"}}
    tables = set(made["gbt"]) - own["gbt"]
    assert tables == set(made["scorecard"]) - own["scorecard"]
    assert {"live_view", "action_list", "pr_curve", "deciles", "decision_table_all"} <= tables
    for name in tables:
        a, b = (spark.read.parquet(made[m][name]) for m in ("scorecard", "gbt"))
        assert sorted(a.columns) == sorted(b.columns), name
        assert b.count() > 0 or name == "target_queue", name
    dec = spark.read.parquet(made["gbt"]["decision_table"])
    assert dec.filter("reason_1 = ''").count() == 0


def test_batch_job_from_a_raw_file(spark, tmp_path):
    """A broken line is in the quarantine and in no other table."""
    from retentio.sources.tables import SUBSCRIBER_SCHEMA
    have = fixture.subscribers(spark, SF_SMALL)
    rows = have.select(*[F.col(f.name) if f.name in have.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in SUBSCRIBER_SCHEMA.fields]).drop("days_to_churn")
    folder = tmp_path / "raw"
    rows.coalesce(1).write.option("header", True).csv(f"{folder}/Churn_Telco.csv")
    with open(f"{folder}/Churn_Telco.csv/part-zz.csv", "w") as f:
        f.write(",".join(rows.columns) + "\nbroken,line\nbroken\n" + ",".join("x" * 30) + "\n")
    paths = jobs.build_all(spark, f"{tmp_path}/out", raw_csv=str(folder))
    lines = [r["line"] for r in spark.read.parquet(paths["quarantine"]).collect()]
    assert sorted(lines) == sorted(["broken,line", "broken", ",".join("x" * 30)])
    n = rows.count()
    for name in ("engineered", "decision_table_all"):
        t = spark.read.parquet(paths[name])
        assert t.count() == n and t.filter("customerID IS NULL").count() == 0


def test_stale_table_is_built_again(spark):
    path = scratch_path(spark, "stale")
    a, b = spark.range(5), spark.range(6)
    assert ensure_table(spark, path, lambda: a, {"a": a}).count() == 5
    assert ensure_table(spark, path, lambda: b, {"a": a.repartition(3)}).count() == 5
    assert ensure_table(spark, path, lambda: b, {"a": b}).count() == 6
    assert fingerprint(a) == fingerprint(a.repartition(4).orderBy(F.col("id").desc())) != fingerprint(b)


def test_point_lookup_reads_one_bucket(spark):
    from retentio.operators import policy as P
    from retentio.plans.tables import bucketed
    t = bucketed(spark.range(4000).select(F.col("id").cast("string").alias("customerID"),
                                          F.lit(1.0).alias("clv")), "points", buckets=8)
    one = P.case_file(t, " 77 ")
    # without a join Spark reads buckets as plain files, but the same ones;
    # its plan names them when it reads them as buckets
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "EqualTo(customerID,77)" in plan and "1 out of 8" in plan
    assert [r["customerID"] for r in one.collect()] == ["77"]


def test_two_level_top_rows_equal_one_level(spark, monkeypatch):
    from retentio.operators import policy as P
    df = spark.range(5000).repartition(7).select(F.col("id"), F.pmod(F.hash("id"), F.lit(50)).alias("v"))
    order = [F.col("v").desc(), F.col("id").asc()]
    one = P.top_rows(df, order, 40, "position").collect()
    monkeypatch.setattr(P, "MERGED_TASKS", 2)
    two = P.top_rows(df, order, 40, "position")
    assert "WindowGroupLimit" in two._jdf.queryExecution().executedPlan().toString()
    assert two.collect() == one and [r["position"] for r in one] == list(range(1, 41))
    places = P.with_position(df, order).orderBy("position").limit(40).collect()
    assert [r["id"] for r in places] == [r["id"] for r in one]


def test_leaf_steps_make_no_row_per_row_and_leaf(lab, model, spark):
    """Scores and contributions meet the leaves inside tasks: no join of rows
    with leaves. Missing values, nan and repeated keys count as before."""
    leaves = materialize(model.leaves(), "leaves")
    matrix = EN.build_matrix(lab, model.encoding, ["customerID"])
    for made in (TR.leaf_scores(matrix, leaves), TR.tree_shapley(matrix, leaves, model.feature_names())):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "MapInArrow" in plan
    one = spark.createDataFrame(
        [(0, 0, 1.0, [0, 1], [None, 2.0], [3.0, None]), (0, 1, 10.0, [0], [3.0], [None])],
        "tree int, leaf int, value double, features array<int>, low array<double>, high array<double>")
    rows = spark.createDataFrame(
        [("a", [3.0, 3.0]), ("a", [4.0, 0.0]), (None, [4.0, 0.0]), ("n", [float("nan"), 0.0]),
         ("m", [None, 5.0]), ("none", [3.0, 2.0]), ("short", [1.0])], "customerID string, x array<double>")
    got = {r[0]: r[1] for r in TR.leaf_scores(rows, one).collect()}
    assert got == {"a": 11.0, None: 10.0, "n": 10.0, "m": 11.0, "short": 1.0}


def test_training_rows_are_spread_over_the_cores(spark):
    """A small file is read by one task; a fit of many rows takes all cores."""
    matrix = spark.range(0, 50_000, 1, 1).select(F.array("id").alias("x"))
    sizes = ML.spread_rows(matrix, 50_000).rdd.glom().map(len).collect()
    assert len(sizes) == 3 and max(sizes) - min(sizes) < 1000
    assert ML.spread_rows(matrix, 20_000) is matrix


def test_a_query_fits_the_labels_it_names(spark, monkeypatch):
    from retentio import catalog as C
    asked = []
    monkeypatch.setattr(C, "_MODELS", {})
    monkeypatch.setattr(C, "matrix", lambda spark, sf: spark.createDataFrame([(False,)], "is_test boolean"))
    monkeypatch.setattr(C, "encoding", lambda spark, sf: None)
    monkeypatch.setattr(ML, "fit_models", lambda train, labels, **kw: asked.append(list(labels)) or {y: y for y in labels})
    assert C.gbt(spark, "at") == "Churn_Target"
    assert list(C.gbt_models(spark, "at")) == list(C.LABELS)
    C.gbt_models(spark, "at", C.LABELS[1:])
    assert asked == [["Churn_Target"], ["y_30d", "y_60d", "y_90d"]]
