"""Versioned folders of boosted models.

A folder's name is a digest of what the models depend on: the training
rows' fingerprint, the labels and the parameters. Its manifest says the
same in full and is written last, so a folder without one is a fit that was
cut off and is done again. A second run on the same rows reads the models.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import jobs as J
from ..plans.manifest import digest, fingerprint, read_manifest, write_manifest
from . import models as ML
from . import shapley as SH
from . import trees as TR
from .encoding import build_matrix


@dataclass
class BoostedModels:
    path: str
    models: dict[str, ML.ChurnModel]
    fitted: bool                       # False: read from the folder

    @property
    def encoding(self):
        return next(iter(self.models.values())).encoding

    def scored(self, lab: DataFrame, test_only: bool = True, contributions: bool = True) -> DataFrame:
        """The rows with the scores of all models and, as `contribs`, the
        exact contributions of the churn model: the form that the scorecard's
        scored table has, for every later table."""
        rows = lab.filter(F.col("is_test")) if test_only else lab
        matrix = build_matrix(rows, self.encoding, lab.columns)
        out = matrix
        for label, model in self.models.items():
            out = model.score_matrix(out, J.SCORE_COLUMNS[label])
        out = out.drop("x")
        if not contributions:
            return out
        long = TR.tree_shapley(matrix, self.models[J.CHURN_LABEL].leaves(), self.encoding.names())
        return out.join(SH.contribution_arrays(long), "customerID", "left")


def fit_or_load(folder: str, lab: DataFrame, params: dict | None = None,
                exclude=ML.EXCLUDE) -> BoostedModels:
    """The churn model and the horizon models of the training rows of `lab`
    (which should be a written table: it is read for the fingerprint and for
    the fit)."""
    spark = lab.sparkSession
    train = lab.filter(~F.col("is_test"))
    labels = [J.CHURN_LABEL, *[y for y in J.WINDOW_LABELS if y in lab.columns]]
    wanted = {"labels": labels, "params": {**ML.GBT_PARAMS, **(params or {})},
              "inputs": sorted(c for c in train.columns if c not in exclude),
              "rows": fingerprint(train)}
    path = f"{folder.rstrip('/')}/{digest(wanted)[:16]}"
    if read_manifest(spark, path) == wanted:
        return BoostedModels(path, {y: ML.load_churn_model(f"{path}/{y}") for y in labels}, False)
    models = ML.fit_models(train, labels, params, exclude)
    for label, model in models.items():
        model.save(f"{path}/{label}")
    write_manifest(spark, path, wanted)
    return BoostedModels(path, models, True)
