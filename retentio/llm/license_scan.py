"""Operator 5 [native]: licence scans of paragraphs.

A sparse multinomial logistic regression over word unigrams and bigrams is
fitted (MLlib) on the labelled table of `license_examples.py`: licence
families, `unknown` (licence-like text of no listed family) and `none`. A
paragraph's grams that the model knows become a sparse vector, which the
fitted model scores in the same stage as the scan: nothing is exploded or
shuffled for it, and a paragraph without a known gram is `none`. A family
counts when its probability reaches a threshold that is calibrated on
examples that the fits have not seen, those of families that a fit was not
told of among them, and when the paragraph's five-word shingles (digits as
0) are found in the family's templates to 0.8 or more; else the paragraph
is `unknown`.

A paragraph is a line, or a wrapped text: a run of lines of at most WIDTH
characters, without a blank one, whose grams speak clearly more for a licence
than no gram at all would, with up to EDGE others between them or at either
end. Such lines are few; only they
(and their neighbours' texts) cross the network, are joined and judged once
more as one paragraph; of a run's variants the one most like a template
counts. A wrapped text of a known family stands for its lines. Comment
leaders are no words and do not matter.

All on the main path is DataFrame functions and fitted MLlib models. The
vocabulary and the templates are bounded by the labelled table (some
thousand entries), whatever the corpus.

Defined cases: null and empty texts have no paragraph; blank lines are
skipped; a paragraph of fewer than five words is one shingle; very long
lines are scored whole; of equally probable families the one later in the
alphabet counts; rows that repeat doc_id and text are one document.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import KEY, row_key
from .license_examples import EXAMPLES

SHINGLE = 5
SIMILARITY = 0.8
NONE, UNKNOWN = "none", "unknown"
#: lines that a wrapped text may have beside those that speak for a licence
EDGE = 3
#: longer lines are not wrapped; a line of a wrapped text lowers the probability
#: of no licence below this share of what a paragraph without known grams has
WIDTH = 200
HINT = 0.9
#: share of right ones among held-out examples that the threshold must reach
PRECISION = 0.95

# Function words are no unigram feature (they stay in bigrams).
COMMON = ["a", "an", "and", "any", "are", "as", "at", "be", "by", "for", "from", "has", "he", "if",
          "in", "is", "it", "its", "no", "not", "of", "on", "or", "she", "so", "that", "the",
          "their", "this", "to", "under", "was", "we", "were", "which", "with", "you", "your"]


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, digits as 0."""
    plain = F.regexp_replace(F.lower(text), r"[0-9]", "0")
    return F.filter(F.split(plain, r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _grams(w: Column) -> Column:
    """Hashes of a word list's unigrams and bigrams."""
    single = F.transform(F.filter(w, lambda x: ~x.isin(COMMON)), lambda x: F.xxhash64(x))
    n = F.size(w)
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1)))).otherwise(F.array().cast("array<long>"))
    return F.array_distinct(F.concat(single, pairs))


def _paragraph_grams() -> Column:
    """Grams of `paragraph`. The word list is a lambda's variable: a filter
    that Spark pushes below this projection then still cuts a paragraph into
    words once."""
    return F.get(F.transform(F.array(words(F.col("paragraph"))), _grams), 0)


def _shingles(w: Column, size: int = SHINGLE) -> Column:
    n = F.greatest(F.size(w) - size + 1, F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        F.array_join(F.slice(w, i + 1, size), " "))))


class LicenseModel:
    """Classes, vocabulary, fitted regression, threshold."""

    def __init__(self, classes: list[str], vectors: CountVectorizerModel,
                 regression: LogisticRegressionModel, threshold: float):
        self.classes, self.vectors = classes, vectors
        self.regression, self.threshold = regression, threshold
        odds = [math.exp(x) for x in regression.interceptVector.toArray()]
        #: probability of no licence for a paragraph without a known gram
        self.base_none = odds[classes.index(NONE)] / sum(odds)

    def scored(self, rows: DataFrame) -> DataFrame:
        """`rows` with their `grams` replaced by family, its probability and
        the one of no licence (`none`)."""
        kept = [c for c in rows.columns if c != "grams"]
        rows = rows.withColumn("grams", F.col("grams").cast("array<string>"))
        p = vector_to_array("probability")
        best = F.array_max(F.arrays_zip(p.alias("p"), F.array(*map(F.lit, self.classes)).alias("c")))
        return (self.regression.transform(self.vectors.transform(rows))
                .select(*kept, best.alias("best"), F.get(p, self.classes.index(NONE)).alias("none"))
                .select(*kept, F.col("best.p").alias("probability"), F.col("best.c").alias("family"),
                        "none"))


def _table(spark: SparkSession) -> DataFrame:
    rows = [(i, family, text) for i, (family, text) in enumerate(
        (f, t) for f, texts in EXAMPLES.items() for t in texts)]
    return (spark.createDataFrame(rows, "id int, family string, text string")
            .select("id", "family", _grams(words(F.col("text"))).alias("grams")).coalesce(1))


def _fit(rows: DataFrame, classes: list[str]) -> tuple[CountVectorizerModel, LogisticRegressionModel]:
    label = F.coalesce(*[F.when(F.col("family") == c, F.lit(float(i)))
                         for i, c in enumerate(classes)])
    named = rows.select(F.col("grams").cast("array<string>").alias("grams"), label.alias("label"))
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(named)
    regression = LogisticRegression(family="multinomial", regParam=3e-3, maxIter=60,
                                    standardization=False)
    fitted = regression.fit(vectors.transform(named))
    if classes[int(fitted.interceptVector.argmax())] != NONE:
        raise ValueError("a paragraph without a known gram must be of no licence")
    return vectors, fitted


def fit(spark: SparkSession) -> LicenseModel:
    """Choose the threshold on held-out examples, then fit on all.

    Two fits, each on every second example of all classes but half of the
    families; they score the rest: unseen examples of the families they know
    and all examples of the others, for which any family is wrong. The
    threshold is the smallest that has the wanted precision on them."""
    rows = _table(spark)
    classes = list(EXAMPLES)
    families = [c for c in classes if c not in (NONE, UNKNOWN)]
    seen = []
    for part in (0, 1):
        known = [c for c in classes if c not in families[part::2]]
        fit_on = (F.col("id") % 2 == part) & F.col("family").isin(known)
        half = LicenseModel(known, *_fit(rows.filter(fit_on), known), 0.0)
        # the labelled table's held-out part: some hundred rows
        seen += (half.scored(rows.filter(~fit_on).select(F.col("family").alias("truth"), "grams"))
                 .filter(~F.col("family").isin(NONE, UNKNOWN)).collect())
    threshold = 1.0
    for step in range(99, 0, -1):
        sure = [r["family"] == r["truth"] for r in seen if r["probability"] >= step / 100]
        if sum(sure) < PRECISION * len(sure):
            break
        threshold = step / 100
    return LicenseModel(classes, *_fit(rows, classes), threshold)


def paragraphs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, _k1, _k2, line, paragraph, behind, ahead: every line that is
    not blank, with up to EDGE lines before and after it (none beyond a
    blank or long one), nearest first."""
    t = F.col(f"`{text}`")
    lines = F.split(t, "\n", -1)

    def up_to_blank(near: Column) -> Column:
        blank = F.array_position(F.transform(
            near, lambda x: (F.trim(x) == "") | (F.length(x) > WIDTH)), True).cast("int")
        return F.when(blank > 0, F.slice(near, F.lit(1), blank - 1)).otherwise(near)

    listed = docs.select("doc_id", *row_key(F.col("doc_id"), t), lines.alias("lines"))
    each = listed.select("doc_id", *KEY, "lines", F.posexplode("lines").alias("line", "paragraph"))
    first = F.greatest(F.col("line") - EDGE, F.lit(0))
    return each.filter(F.trim("paragraph") != "").select(
        "doc_id", *KEY, "line", "paragraph",
        up_to_blank(F.reverse(F.slice("lines", first + 1, F.col("line") - first))).alias("behind"),
        up_to_blank(F.slice("lines", F.col("line") + 2, F.lit(EDGE))).alias("ahead"))


def _wrapped(hints: DataFrame, model: LicenseModel) -> DataFrame:
    """Runs of hints, with what stands between them, judged as one paragraph;
    each also with up to EDGE more lines at either end. The lines of one
    document that speak for a licence stand in one window."""
    by = Window.partitionBy(*KEY).orderBy("line")
    starts = F.coalesce((F.lag(F.col("line") + F.size("ahead")).over(by) < F.col("line")), F.lit(True))
    gap = F.lead("line").over(by) - F.col("line") - 1
    between = F.when(gap <= F.size("ahead"), F.slice("ahead", F.lit(1), F.greatest(gap, F.lit(0))))
    runs = (hints.filter(F.length("paragraph") <= WIDTH).withColumn("start", starts.cast("int")).withColumn("between", F.coalesce(
                between, F.array().cast("array<string>")))
            .withColumn("run", F.sum("start").over(by))
            .groupBy(*KEY, "run").agg(
                F.first("doc_id").alias("doc_id"), F.min("line").alias("line"),
                F.max("line").alias("last_line"),
                F.min_by("behind", "line").alias("behind"), F.max_by("ahead", "line").alias("ahead"),
                F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(
                    "line", F.concat(F.array("paragraph"), "between").alias("ls")))),
                    lambda x: x["ls"])).alias("ls")))

    def judged(rows: DataFrame, name: str) -> DataFrame:
        """Written before and after: no expression is copied into another."""
        text = materialize(rows.withColumn("paragraph", F.array_join("ls", "\n")), name)
        return materialize(model.scored(text.withColumn("grams", _paragraph_grams())), name).filter(
            F.col("family") != NONE)

    held = judged(runs, "license_runs").drop("family", "probability", "none")
    more = (held.withColumn("back", F.explode(F.sequence(F.lit(0), F.size("behind"))))
            .withColumn("on", F.explode(F.sequence(F.lit(0), F.size("ahead"))))
            .select("doc_id", *KEY, "run", (F.col("line") - F.col("back")).alias("line"),
                    (F.col("last_line") + F.col("on")).alias("last_line"),
                    F.concat(F.reverse(F.slice("behind", F.lit(1), F.col("back"))), "ls",
                             F.slice("ahead", F.lit(1), F.col("on"))).alias("ls")))
    return judged(more, "license_variants")


def scan(docs: DataFrame, model: LicenseModel | None = None, text: str = "text") -> DataFrame:
    """doc_id, _k1, _k2, line, last_line, family, probability, similarity,
    paragraph: one row per licence paragraph (family may be `unknown`)."""
    spark = docs.sparkSession
    model = model or fit(spark)
    place = [*KEY, "line", "last_line"]
    kept = ["doc_id", *place, "run", "paragraph", "probability", "family"]
    graded = model.scored(paragraphs(docs, text).withColumn("grams", _paragraph_grams()))
    # only lines that speak for a licence cross the network
    speaks = (F.col("none") < HINT * model.base_none) & (F.length("paragraph") <= WIDTH)
    hints = materialize(graded.filter((F.col("family") != NONE) | speaks)
                        .withColumn("last_line", F.col("line"))
                        .dropDuplicates([*KEY, "line"]), "license_lines")
    one = hints.filter(F.col("family") != NONE).withColumn("run", F.lit(None).cast("long"))
    found = materialize(one.select(*kept).union(_wrapped(hints, model).select(*kept)),
                        "license_paragraphs")
    templates = spark.createDataFrame(
        [(f, t) for f, texts in EXAMPLES.items() if f not in (NONE, UNKNOWN) for t in texts],
        "family string, text string").select(
        "family", F.explode(_shingles(words(F.col("text")))).alias("h")).distinct() \
        .withColumn("known", F.lit(1))
    similarity = (found.select(*place, "family", F.explode(_shingles(words(F.col("paragraph"))))
                               .alias("h"))
                  .join(templates, ["family", "h"], "left").groupBy(*place)
                  .agg((F.count("known") / F.count("*")).alias("similarity")))
    sure = ((F.col("probability") >= model.threshold) & (F.col("similarity") >= SIMILARITY)
            & (F.col("family") != UNKNOWN))
    judged = materialize(
        found.join(similarity, place)
        .withColumn("family", F.when(sure, F.col("family")).otherwise(F.lit(UNKNOWN)))
        .select("doc_id", *place, "run", "family", "probability", "similarity", "paragraph"),
        "licenses")
    # of a run's variants the one most alike, and of these the longest; where
    # that is one line, the line stands for itself
    best = Window.partitionBy(*KEY, "run").orderBy(
        F.col("similarity").desc(), (F.col("line") - F.col("last_line")).asc(), "line")
    whole = (judged.filter(F.col("run").isNotNull() & (F.col("family") != UNKNOWN))
             .withColumn("n", F.row_number().over(best))
             .filter("n = 1 AND line < last_line").drop("n", "run"))
    # a line that is more like its template than the run around it stands alone
    lines = judged.filter("run IS NULL AND family <> 'unknown'").select(
        F.col("_k1").alias("l1"), F.col("_k2").alias("l2"), F.col("line").alias("at"),
        F.col("similarity").alias("alike"))
    whole = whole.join(lines, (F.col("_k1") == F.col("l1")) & (F.col("_k2") == F.col("l2"))
                       & F.col("at").between(F.col("line"), F.col("last_line"))
                       & (F.col("alike") > F.col("similarity")), "left_anti")
    spans = whole.select(F.col("_k1").alias("w1"), F.col("_k2").alias("w2"),
                         F.col("line").alias("first"), F.col("last_line").alias("last"))
    inside = ((F.col("_k1") == F.col("w1")) & (F.col("_k2") == F.col("w2"))
              & F.col("line").between(F.col("first"), F.col("last")))
    return judged.filter("run IS NULL").drop("run").join(spans, inside, "left_anti").union(whole)


def license_query(docs: DataFrame) -> DataFrame:
    out = scan(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("line").cast("long").alias("line"),
                      F.col("last_line").cast("long").alias("last_line"), "family",
                      F.round("probability", 6).alias("probability"),
                      F.round("similarity", 6).alias("similarity"), "paragraph")
