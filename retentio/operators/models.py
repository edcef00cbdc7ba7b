"""Distributed gradient-boosted churn models.

Encoding (G2) is planned once on the training rows and bounded
(`encoding`); the classifiers (G3) are MLlib GBTs with a class weight column
(pos_weight for churners) that all fit from one written matrix. A fitted
model is also a table of nodes and of leaves (`trees`), for scoring by join
and for exact contributions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import scratch_path
from . import encoding as E
from . import trees
from .features import MODEL_EXCLUDE

# xgboost-like defaults (100 trees, depth 6, learning rate 0.3)
GBT_PARAMS = dict(maxIter=100, maxDepth=6, stepSize=0.3, seed=42, maxBins=64)
EXCLUDE = MODEL_EXCLUDE
WINDOWS = (30, 60, 90)
#: fits that run at a time; training rows of one task, at least and about at most
PARALLEL_FITS = 4
TASK_ROWS = (20_000, 1_000_000)


def _part(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


@dataclass
class ChurnModel:
    encoding: E.Encoding
    gbt: GBTClassificationModel
    label: str
    path: str | None = None          # folder the classifier was saved in

    @property
    def numeric(self) -> list[str]:
        return self.encoding.numeric

    @property
    def categorical(self) -> list[str]:
        return self.encoding.categorical

    @property
    def fill(self) -> dict[str, float]:
        return self.encoding.fill

    def transform(self, df: DataFrame, out: str = "churn_prob") -> DataFrame:
        """P(class 1) as a double column; model columns dropped."""
        rows = E.with_features(df.withColumn("_x", self.encoding.column()), "_x")
        scored = self.gbt.transform(rows)
        scored = scored.withColumn(out, vector_to_array(F.col("probability"))[1])
        return scored.drop("_x", "features", "rawPrediction", "probability", "prediction")

    def score_matrix(self, matrix: DataFrame, out: str = "churn_prob") -> DataFrame:
        """As `transform`, from rows of the written matrix."""
        scored = self.gbt.transform(E.with_features(matrix))
        scored = scored.withColumn(out, vector_to_array(F.col("probability"))[1])
        return scored.drop("features", "rawPrediction", "probability", "prediction")

    def feature_names(self) -> list[str]:
        """Encoded names in vector order."""
        return self.encoding.names()

    def feature_importance(self, spark, top: int = 20) -> DataFrame:
        """importances joined to names, top `top` (bounded by the
        number of encoded features)."""
        imp = self.gbt.featureImportances.toArray().tolist()
        rows = sorted(zip(self.feature_names(), imp), key=lambda t: (-t[1], t[0]))[:top]
        return spark.createDataFrame(rows, "feature string, importance double")

    def save(self, path: str) -> None:
        """The classifier and, beside it, how its inputs are encoded."""
        self.gbt.write().overwrite().save(_part(path, "gbt"))
        table = self.encoding.table(SparkSession.getActiveSession())
        (table.withColumn("label", F.lit(self.label)).coalesce(1)
         .write.mode("overwrite").parquet(_part(path, "inputs")))
        self.path = path

    def nodes(self) -> DataFrame:
        """The fitted trees as a node table, cuts in raw values beside those
        of the matrix (`raw_cut`, numeric inputs only)."""
        spark = SparkSession.getActiveSession()
        if self.path is None:
            self.save(scratch_path(spark, "gbt"))
        raw = F.array(*[F.array(*map(F.lit, self.encoding.cuts[c])).cast("array<double>")
                        for c in self.numeric] or [F.array().cast("array<double>")])
        nodes = trees.node_table(spark, _part(self.path, "gbt"), self.label)
        # bin b holds the values up to the b-th cut
        return nodes.withColumn("raw_cut", F.when(
            F.col("feature").between(0, len(self.numeric) - 1),
            F.get(F.get(raw, F.col("feature")), F.floor("cut").cast("int"))))

    def leaves(self) -> DataFrame:
        return trees.leaf_table(self.nodes().drop("raw_cut"))


def fit_models(train: DataFrame, labels, params: dict | None = None, exclude=EXCLUDE,
               encoding: E.Encoding | None = None, matrix: DataFrame | None = None) -> dict:
    """G2 + G3 + G10: one model per label, all from one encoding and one
    written matrix (+ D16 class weights, D17 medians)."""
    labels = list(labels)
    if encoding is None:
        train = E.materialize(train, "train")
        encoding = E.plan_encoding(train, exclude)
    if matrix is None:
        matrix = E.build_matrix(train, encoding, labels)
    counts = matrix.agg(F.count("*").alias("rows"), *[
        F.count_if(F.col(l) == v).alias(f"{l}_{v}") for l in labels for v in (0, 1)]).first()
    p = {**GBT_PARAMS, **(params or {})}
    spread = spread_rows(matrix.select("x", *labels), counts["rows"])

    def fit(label: str) -> ChurnModel:
        weight = counts[f"{label}_0"] / max(counts[f"{label}_1"], 1)
        rows = E.with_features(spread.filter(F.col(label).isNotNull())).select(
            "features", F.col(label).cast("double").alias("label"),
            F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)).alias("weight"))
        gbt = GBTClassifier(weightCol="weight", checkpointInterval=10, **p).fit(rows)
        return ChurnModel(encoding, gbt, label)

    # a level of a tree is a short job: fits side by side fill each other's gaps
    with ThreadPool(max(min(PARALLEL_FITS, len(labels)), 1)) as pool:
        return dict(zip(labels, pool.map(inheritable_thread_target(matrix.sparkSession)(fit), labels)))


def spread_rows(matrix: DataFrame, n_rows: int) -> DataFrame:
    """The training rows in even tasks for all cores. The matrix is a table
    of few bytes, so few tasks read it, and a fit would keep to those."""
    least, most = TASK_ROWS
    if n_rows <= least:
        return matrix
    cores = matrix.sparkSession.sparkContext.defaultParallelism
    return matrix.repartition(max(min(cores, math.ceil(n_rows / least)), math.ceil(n_rows / most)))


def fit_churn_model(train: DataFrame, label: str = "Churn_Target", params: dict | None = None,
                    exclude=EXCLUDE) -> ChurnModel:
    return fit_models(train, [label], params, exclude)[label]


def load_churn_model(path: str) -> ChurnModel:
    """The model as saved; the folder alone is enough."""
    gbt = GBTClassificationModel.load(_part(path, "gbt"))
    inputs = SparkSession.getActiveSession().read.parquet(_part(path, "inputs"))
    return ChurnModel(E.Encoding.from_table(inputs), gbt, inputs.first()["label"], path)


def fit_window_models(train: DataFrame, windows=WINDOWS, params: dict | None = None) -> dict:
    """One model per horizon label y_{w}d on the same training rows."""
    models = fit_models(train, [f"y_{w}d" for w in windows], params)
    return {w: models[f"y_{w}d"] for w in windows}
