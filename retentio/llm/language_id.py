"""Operator 6: language identification in two steps.

First the language family, then the language within it, each by
one-versus-one linear support vector machines (MLlib's LinearSVC) over
hashed byte bigrams and trigrams of the lower-cased letters of the whole
text. Votes decide; ties go to the larger sum of margins. The score is the
product of the two steps' mean logistic margins (0 to 1).

The machines are fitted on a sample of the labelled rows: about
SAMPLE_PER_LANGUAGE rows of each language, chosen by a hash of doc_id; every
lang value is a class, so machines grow with the square of the families.
Training rows are those whose crc32(doc_id as text) mod 4 is not 2 and whose
lang and text are not null. Only the text is an input of a prediction.

Defined cases: a text that is null or has no letter is `und` with score 0;
with one known language every other text gets it with score 1; with no
labelled row all texts are `und`.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import bounded_batches

SAMPLE_PER_LANGUAGE = 600
FEATURES = 2048
UNKNOWN = "und"

# Families of common ISO 639-1 codes. A code that is not
# listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "ur", "mr", "ne"),
}


def family_of(language: str) -> str:
    return next((f for f, codes in FAMILIES.items() if language in codes), language)


def _byte_classes() -> np.ndarray:
    """Letters keep their byte, all other ASCII becomes a space."""
    table = np.arange(256, dtype=np.uint32)
    for b in range(128):
        if not chr(b).isalpha():
            table[b] = 32
    return table


_CLASS = _byte_classes()
_PART = 1 << 22


def features(text: str) -> np.ndarray:
    """Unit vector of square-rooted hashed bigram and trigram counts."""
    data = np.frombuffer(text.lower().encode("utf-8"), dtype=np.uint8)
    counts = np.zeros(FEATURES)
    for at in range(0, len(data), _PART):       # two bytes overlap between parts
        b = _CLASS[data[max(0, at - 2):at + _PART]]
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(263) + b[2:]
        if at:
            two = two[1:]
        for gram, salt in ((two, 0x9E3779B1), (three, 0x85EBCA6B)):
            slot = (gram * np.uint32(salt)) >> np.uint32(32 - FEATURES.bit_length() + 1)
            counts += np.bincount(slot, minlength=FEATURES)
    root = np.sqrt(counts)
    norm = np.linalg.norm(root)
    return root / norm if norm else root


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t or "") for t in texts], dtype=object)

    return vectors(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE,
                    text: str = "text", label: str = "lang") -> DataFrame:
    """label, x: a bounded sample of the labelled rows. Each language is
    thinned by a hash of (doc_id, text) to about `per_language` rows; rows
    that repeat both are one row, so the hash spreads whatever repeats. The
    texts become vectors in the tasks that hold them: no task or driver gets
    them all."""
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text"),
                       F.col(f"`{label}`").alias("label")).filter(
        F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    # one row per language, as many as the model has classes
    counts = materialize(rows.groupBy("label").agg(F.count("*").alias("n")), "language_counts")
    share = F.lit(per_language) / F.col("n")
    chosen = (rows.withColumn("o", F.xxhash64("doc_id", "text"))
              .join(F.broadcast(counts), "label")
              .filter(F.pmod("o", F.lit(1 << 20)) < share * (1 << 20))
              .dropDuplicates(["o", "label"]))
    return materialize(chosen.select("label", feature_column(F.col("text")).alias("x")), "language_sample")


class LanguageModel:
    """Pairwise machines: between families, and inside each family."""

    def __init__(self, languages: list[str], machines: dict):
        self.languages = languages
        self.families = sorted({family_of(x) for x in languages})
        self.members = {f: [x for x in languages if family_of(x) == f] for f in self.families}
        self.machines = machines

    def _choose(self, names: list[str], margins: np.ndarray, index: dict) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        votes = {n: [0, 0.0, 0.0] for n in names}
        for a, b in combinations(names, 2):
            m = margins[index[a, b]]
            for name, margin in ((a, -m), (b, m)):
                v = votes[name]
                v[0] += margin > 0
                v[1] += margin
                v[2] += 1 / (1 + math.exp(-max(-30.0, min(30.0, 2 * margin))))
        best = max(names, key=lambda n: (votes[n][0], votes[n][1], n))
        return best, votes[best][2] / (len(names) - 1)

    def predict(self, texts) -> list[tuple[str, float]]:
        pairs = sorted(self.machines)
        index = {p: i for i, p in enumerate(pairs)}
        w = np.array([self.machines[p][0] for p in pairs]).reshape(len(pairs), FEATURES)
        c = np.array([self.machines[p][1] for p in pairs])
        out = []
        for text in texts:
            if not self.languages or not has_letter(text):
                out.append((UNKNOWN, 0.0))
                continue
            margins = w @ features(text) + c
            family, p = self._choose(self.families, margins, index)
            language, q = self._choose(self.members[family], margins, index)
            out.append((language, p * q))
        return out


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, text: str = "text",
        label: str = "lang") -> LanguageModel:
    bounded_batches(docs.sparkSession)
    sample = training_sample(docs, per_language, text, label)
    known = sorted(r["label"] for r in sample.select("label").distinct().collect())
    family = F.create_map(*[F.lit(v) for x in known for v in (x, family_of(x))]) if known else None
    machines = {}

    def pairs(names: list[str], name: Column) -> None:
        for a, b in combinations(names, 2):
            part = (sample.filter(name.isin(a, b))
                    .select((name == b).cast("double").alias("label"),
                            array_to_vector("x").alias("features")).coalesce(2))
            m = LinearSVC(maxIter=20, regParam=1e-3, standardization=False).fit(part)
            machines[a, b] = (np.array(m.coefficients.toArray()), float(m.intercept))

    model = LanguageModel(known, machines)
    if known:
        pairs(model.families, F.element_at(family, F.col("label")))
        for members in model.members.values():
            pairs(members, F.col("label"))
    return model


def language_column(model: LanguageModel, text: Column) -> Column:
    """struct(lang_pred, score) of a text. The machines are broadcast once:
    two numbers per feature and pair, whatever the corpus."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict(texts), columns=["lang_pred", "score"])

    # so that a filter on the prediction does not compute it once more
    return predict.asNondeterministic()(text)


def identify(docs: DataFrame, model: LanguageModel | None = None, text: str = "text",
             out: str = "language") -> DataFrame:
    """`docs` with struct `out`(lang_pred, score); the model is fitted on
    `docs` when none is given. Predicting is one narrow stage."""
    model = model or fit(docs, text=text)
    return docs.withColumn(out, language_column(model, F.col(f"`{text}`")))


def keep_identified(docs: DataFrame, model: LanguageModel | None = None,
                    label: str = "lang") -> DataFrame:
    """`docs` without the rows whose language can't be told; a row that has
    no `label` gets the predicted one. Rows that had one keep it: the score
    decides nothing, so that no clean document goes."""
    found = identify(docs, model, out="_language").filter(F.col("_language.lang_pred") != UNKNOWN)
    return found.withColumn(label, F.coalesce(F.col(f"`{label}`"), F.col("_language.lang_pred"))).select(
        *[f"`{c}`" for c in docs.columns])


def language_query(docs: DataFrame) -> DataFrame:
    out = identify(docs.select("doc_id", "text", "lang"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      "language.lang_pred", "language.score")
