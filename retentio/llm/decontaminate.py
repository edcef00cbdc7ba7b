"""Operator 9 [native]: benchmark decontamination with SimHash windows.

1. Windows. A window has the size (in words) of a benchmark item. At
   similarity 0.8 at least four fifths of the item's shingles are counted in
   the window, so at least as many of the window's positions hold a shingle
   of the item. A document's positions that hold one are listed per item;
   windows are placed at every start from which one can cover that many of
   them, at whatever place and in whatever order they stand in the item.
   No window that can reach 0.8 is left out.
2. Fingerprints. Each window and item gets a 64-bit SimHash of its words.
3. Multi-index blocks. The 64 bits are eight blocks of eight. Two prints
   within RADIUS = 23 bits differ in at most two bits of some block, so every
   item is filed under each block's value and its 36 neighbours of one or two
   flipped bits, for windows of its size; an equi-join finds all prints within
   the radius. A match is lost only when each of its windows that reaches 0.8
   has a print farther than that: no radius below 64 rules this out for every
   text (a test measures it on cut, swapped and edited passages).
4. Verification. The weighted similarity of the five-word shingle counts
   (sum of minima over sum of maxima) must reach 0.8.

Everything is DataFrame functions. The shingle index and the block index
grow with the benchmark only; they are broadcast when they have at most
MAX_BROADCAST_ROWS rows (counted first), else joined by shuffle. So do the
two-number keys of the documents that have windows: only those documents'
texts move. With more of them than MAX_BROADCAST_ROWS all texts are shuffled.

Words are runs of letters and digits, lower-cased. Defined cases: items and
documents that are null or have no word match nothing; an item of fewer
than five words is one shingle of that many words, and so are windows of
its size; windows are cut at the ends of a document; rows that repeat both
doc_id and text count as one document; items that repeat id and text, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import KEY, ROW, row_key, whole_row

SHINGLE = 5
SIMILARITY = 0.8
#: BLOCKS * (FLIPS + 1) - 1: every pair of prints within it shares a key
BLOCKS, FLIPS = 8, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
MAX_BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _shingles(word_list: Column, size: int) -> Column:
    """Hashes of all runs of `size` words."""
    n = F.size(word_list) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        *[F.get(word_list, i + j) for j in range(size)])))


def _small(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast when its counted size is bounded."""
    return F.broadcast(df) if df.count() <= most else df


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, item (row hash), w (its words), size, k (shingle length)."""
    w = benchmark.select("item_id", *row_key(F.col("item_id"), F.col("text")),
                         words(F.col("text")).alias("w")).dropDuplicates(KEY)
    return w.withColumn("size", F.size("w")).filter(F.col("size") > 0).select(
        "item_id", F.col("_k1").alias("item"), "w", "size",
        F.least("size", F.lit(SHINGLE)).alias("k"))


def _item_shingles(items: DataFrame, lengths: list[int]) -> DataFrame:
    """item, size, k, h, at: every shingle of every item."""
    each = F.coalesce(*[F.when(F.col("k") == k, _shingles(F.col("w"), k)) for k in lengths])
    return items.select("item", "size", "k", F.posexplode(each).alias("at", "h"))


def _placed(docs: DataFrame, shingles: DataFrame, lengths: list[int], text: str) -> DataFrame:
    """_k1, _k2, start, size: the windows to look at."""
    t = F.col(f"`{text}`")
    listed = docs.select(*row_key(F.col("doc_id"), t), words(t).alias("w"))
    index = _small(shingles.select("item", "size", "k", "h").distinct())
    found = []
    for k in lengths:
        hits = (listed.select(*KEY, F.posexplode(_shingles(F.col("w"), k)).alias("at", "h"))
                .join(index.filter(F.col("k") == k), "h"))
        found.append(hits.select(*KEY, "item", "size", "k", "at"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    # the places in one document that hold a shingle of one item: fewer than
    # the document has words
    places = hits.groupBy(*KEY, "item", "size", "k").agg(
        F.sort_array(F.collect_set("at")).alias("at"))
    total = F.col("size") - F.col("k") + 1
    need = F.floor((4 * total + 4) / 5).cast("int")
    spans = F.transform(
        F.sequence(F.lit(0), F.size("at") - F.col("need")),
        lambda j: F.struct((F.get("at", j + F.col("need") - 1) - F.col("total") + 1).alias("first"),
                           F.get("at", j).alias("last")))
    return (places.withColumn("total", total).withColumn("need", need)
            .filter(F.size("at") >= F.col("need"))
            .select(*KEY, "size", F.explode(spans).alias("s")).filter("s.first <= s.last")
            .select(*KEY, "size", F.explode(F.sequence("s.first", "s.last")).alias("start"))
            .distinct())


def _simhash(rows: DataFrame, by: list[str]) -> DataFrame:
    """`by`, fp: SimHash of the words in column w."""
    h = rows.select(*by, F.explode("w").alias("word")).withColumn("h", F.xxhash64("word"))
    n = F.count("*")
    bits = [F.when(2 * F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))) > n,
                   F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long")
            for b in range(64)]
    fp = bits[0]
    for b in bits[1:]:
        fp = fp.bitwiseOR(b)
    return h.groupBy(*by).agg(fp.alias("fp"))


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255))


def _exploded_blocks(near: bool) -> Column:
    """struct(block, value) of every block, and its neighbours of up to
    FLIPS flipped bits."""
    flips = [x for x in range(256) if x.bit_count() <= (FLIPS if near else 0)]
    return F.explode(F.array(*[F.struct(
        F.lit(i).alias("block"), _block(F.col("fp"), i).bitwiseXOR(F.lit(x)).alias("value"))
        for i in range(BLOCKS) for x in flips])).alias("b")


def _counted(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by, "h").agg(F.count("*").alias("n"))


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, _k1, _k2, item_id, start, size, similarity: every window of a
    document that is like a benchmark item."""
    items = materialize(_items(benchmark), "items")
    lengths = sorted(r["k"] for r in items.select("k").distinct().collect()) or [SHINGLE]
    shingles = materialize(_item_shingles(items, lengths), "item_shingles")
    placed = (_placed(docs, shingles, lengths, text)
              .groupBy(*KEY).agg(F.collect_list(F.struct("start", "size")).alias("windows")))
    placed = materialize(placed, "windows")
    t = F.col(f"`{text}`")
    # the words are a column used several times, so they are made once a row
    # only documents with windows move: their keys are few
    held = (docs.select("doc_id", *row_key(F.col("doc_id"), t), t.alias("text"))
            .join(_small(placed.select(*KEY)), KEY, "left_semi")
            .join(placed, KEY).dropDuplicates(KEY)
            .select("doc_id", *KEY, "windows", words(F.col("text")).alias("all")))
    windows = materialize(held.select("doc_id", *KEY, F.explode(F.transform(
        "windows", lambda x: F.struct(
            x["start"].alias("start"), x["size"].alias("size"),
            F.slice("all", F.greatest(x["start"], F.lit(0)) + 1,
                    F.greatest(F.least(x["start"] + x["size"], F.size("all"))
                               - F.greatest(x["start"], F.lit(0)), F.lit(0))).alias("w")))
        ).alias("x")).select("doc_id", *KEY, "x.start", "x.size", "x.w"), "window_words")
    window = [*KEY, "start", "size"]
    prints = _simhash(windows, window)
    index = _small(_simhash(items, ["item", "size"])
                   .select("item", "size", F.col("fp").alias("item_fp"),
                           _exploded_blocks(near=True)).select("item", "size", "item_fp", "b.*"))
    near = (prints.select(*window, "fp", _exploded_blocks(near=False))
            .select(*window, "fp", "b.*").join(index, ["size", "block", "value"])
            .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
            .select(*window, "item").distinct())
    return _verified(windows, near, items, shingles, lengths, window)


def _verified(windows: DataFrame, near: DataFrame, items: DataFrame, shingles: DataFrame,
              lengths: list[int], window: list[str]) -> DataFrame:
    k = F.least("size", F.lit(SHINGLE))
    each = F.coalesce(*[F.when(k == n, _shingles(F.col("w"), n)) for n in lengths])
    own = _counted(windows.select(*window, F.explode(each).alias("h")), window)
    theirs = _small(_counted(shingles, ["item"]).withColumnRenamed("n", "m"))
    shared = (near.join(own, window).join(theirs, ["item", "h"])
              .groupBy(*window, "item").agg(F.sum(F.least("n", "m")).alias("both")))
    total = (own.groupBy(*window).agg(F.sum("n").alias("total")))
    whole = _small(items.select("item", "item_id", F.col("size").alias("words"),
                                (F.col("size") - F.col("k") + 1).alias("item_total")))
    return (shared.join(total, window).join(whole, "item")
            .withColumn("similarity", F.col("both") /
                        (F.col("total") + F.col("item_total") - F.col("both")))
            .filter(F.col("similarity") >= SIMILARITY)
            .join(windows.select("doc_id", *window), window)
            .select("doc_id", *KEY, "item_id", "start", "size", "similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without the rows that hold a benchmark item."""
    found = materialize(matches(docs, benchmark, text).select(*KEY).distinct(), "contaminated")
    return (docs.select(whole_row(), *row_key(F.col("doc_id"), F.col(f"`{text}`")))
            .join(found, KEY, "left_anti").select(f"{ROW}.*"))


def contamination_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that meet: the best window."""
    found = matches(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    return (found.groupBy("doc_id", *KEY, "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("m"),
                 F.count("*").alias("n_windows"))
            .select("doc_id", "item_id", (-F.col("m.s")).cast("long").alias("first_word"),
                    F.round("m.similarity", 6).alias("similarity")))
