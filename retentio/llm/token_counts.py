"""Operator 2: token counts that follow edits.

State per document: the text, cut into segments (white space up to the next
white space, so no pre-token crosses a border), and for each segment its
characters and tokens. Over the segments stands a segment tree of the two
sums. An edit (start, length, replacement) descends the tree to the
segments it touches, takes one neighbour on each side as context, cuts and
encodes only that region anew, and updates the sums above it. Positions of
later edits refer to the text after the earlier ones.

Defined cases: a null text counts as empty and has no segments; a null
list of edits means no edit, a null entry is skipped; positions are clamped
to the text as it then stands; repeated rows are counted one by one;
documents keep their own columns.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import SPACE, WordBpe, model_of, read_tokenizer

_SEGMENT = re.compile(f"[^{SPACE}]*[{SPACE}]+|[^{SPACE}]+")

STATE = "text string, seg_chars array<int>, seg_tokens array<int>, n_tokens long"
EDITED = STATE + ", n_edits int, segments_encoded long, n_segments long"
EDITS = "array<struct<start:long,length:long,replacement:string>>"


def segments(text: str) -> list[str]:
    return _SEGMENT.findall(text)


def count(model: WordBpe, segment: str) -> int:
    """Tokens of a segment. A word of letters counts as the segment that is
    this word and one space, which is often known already."""
    piece = segment.strip(SPACE)
    if "<|" in piece:
        return len(model.encode(piece)) // 4
    total = 0
    for word in model.words(piece):
        n = _KNOWN.get(word + " ") if word.isalpha() else None
        total += len(model.word(word.encode("utf-8"))) if n is None else n
    return total


#: counts of recent segments, of one Python worker; KNOWN short entries take some 100 MB
_KNOWN: dict[str, int] = {}
KNOWN = 600_000


def counts(model: WordBpe, parts: list[str]) -> list[int]:
    out = list(map(_KNOWN.get, parts))
    if None in out:
        for i, n in enumerate(out):
            if n is None:
                out[i] = n = count(model, parts[i])
                if len(parts[i]) <= 32:
                    if len(_KNOWN) >= KNOWN:
                        _KNOWN.clear()
                    _KNOWN[parts[i]] = n
    return out


class SegmentTree:
    """Characters and tokens of segments, summed over a binary tree. After
    an edit a leaf may stand for several segments (in `changed`), or none."""

    def __init__(self, text: str, chars, tokens):
        self.text = text
        self.leaves = np.array([chars, tokens], dtype=np.int64).reshape(2, -1).T
        n = max(1, len(self.leaves))
        self.n, self.size = n, 1 << (n - 1).bit_length()
        self.changed: dict[int, tuple[list[int], list[int]]] = {}
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        self.sums[self.size:self.size + len(self.leaves)] = self.leaves
        level = self.size
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level:2 * level].reshape(half, 2, 2).sum(axis=1)
            level = half

    def leaf_at(self, char: int) -> int:
        """The leaf that holds a character."""
        node, before, sums = 1, 0, self.sums
        while node < self.size:
            node *= 2
            if char - before >= sums[node, 0]:
                before += int(sums[node, 0])
                node += 1
        return min(node - self.size, self.n - 1)

    def _put(self, first: int, last: int, chars: list[int], tokens: list[int]) -> None:
        """Leaves first..last become one leaf with these segments."""
        for i in range(first, last + 1):
            self.changed[i] = ([], [])
        self.changed[first] = (chars, tokens)
        low, high = first + self.size, last + self.size
        self.sums[low:high + 1] = 0
        self.sums[low] = sum(chars), sum(tokens)
        while low > 1:
            low, high = low // 2, high // 2
            self.sums[low:high + 1] = self.sums[2 * low:2 * high + 2].reshape(-1, 2, 2).sum(axis=1)

    def edit(self, model: WordBpe, start: int, length: int, replacement: str) -> int:
        """Apply one edit; the number of segments encoded anew."""
        total = len(self.text)
        start = min(max(start, 0), total)
        stop = min(start + max(length, 0), total)
        # the leaves it touches, and one with text on each side: the edit may
        # join their segments to the region
        first = self._filled(self.leaf_at(max(start - 1, 0)), -1)
        last = self._filled(self.leaf_at(min(stop, max(total - 1, 0))), 1)
        before, after = self._chars_before(first), self._chars_before(last)
        after += int(self.sums[last + self.size, 0])
        region = self.text[before:start] + replacement + self.text[stop:after]
        self.text = self.text[:start] + replacement + self.text[stop:]
        parts = segments(region)
        self._put(first, last, list(map(len, parts)), counts(model, parts))
        return len(parts)

    def _filled(self, leaf: int, step: int) -> int:
        at = leaf + step
        while 0 <= at < self.n:
            if self.sums[at + self.size, 0]:
                return at
            at += step
        return leaf

    def _chars_before(self, leaf: int) -> int:
        node, before = leaf + self.size, 0
        while node > 1:
            if node % 2:
                before += int(self.sums[node - 1, 0])
            node //= 2
        return before

    def segments(self) -> np.ndarray:
        """Characters and tokens of all segments, in order."""
        out, at = [], 0
        for leaf in sorted(self.changed):
            out.append(self.leaves[at:leaf])
            out.append(np.array(self.changed[leaf], dtype=np.int64).reshape(2, -1).T)
            at = leaf + 1
        return np.concatenate([*out, self.leaves[at:]])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    """One Arrow list of integers per array."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """The integers of each list; a null list is empty."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] if known else values[:0]
            for a, b, known in zip(ends, ends[1:], column.is_valid().to_pylist())]


def state_column(tokenizer, text: Column) -> Column:
    """struct(text, seg_chars, seg_tokens, n_tokens) of a text."""
    @F.arrow_udf(STATE)
    def state(texts: pa.Array) -> pa.Array:
        model, chars, tokens = model_of(tokenizer.value), [], []
        texts = texts.fill_null("")
        for text in texts.to_pylist():
            parts = segments(text)
            chars.append(np.fromiter(map(len, parts), np.int32, len(parts)))
            tokens.append(np.array(counts(model, parts), dtype=np.int32))
        totals = [int(t.sum()) for t in tokens]
        return pa.StructArray.from_arrays(
            [texts, _lists(chars), _lists(tokens), pa.array(totals, pa.int64())],
            ["text", "seg_chars", "seg_tokens", "n_tokens"])

    return state(text)


def edited_column(tokenizer, state: Column, edits: Column) -> Column:
    """The state after the edits, with how much was encoded for it."""
    @F.arrow_udf(EDITED)
    def edited(before: pa.Array, edit_lists: pa.Array) -> pa.Array:
        model, trees, chars, tokens, work = model_of(tokenizer.value), [], [], [], []
        texts, seg_chars, seg_tokens, _ = before.flatten()
        for text, c, t, edit_list in zip(texts.to_pylist(), _arrays(seg_chars),
                                         _arrays(seg_tokens), edit_lists.to_pylist()):
            tree = SegmentTree(text or "", c, t)
            made = done = 0
            for e in edit_list or []:
                if e is not None:
                    made += tree.edit(model, e["start"] or 0, e["length"] or 0,
                                      e["replacement"] or "")
                    done += 1
            parts = tree.segments()
            chars.append(parts[:, 0])
            tokens.append(parts[:, 1])
            trees.append(tree.text)
            work.append((int(tree.sums[1, 1]), done, made, len(parts)))
        total, done, made, size = zip(*work) if work else ((), (), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(trees, pa.string()), _lists(chars), _lists(tokens),
             pa.array(total, pa.int64()), pa.array(done, pa.int32()),
             pa.array(made, pa.int64()), pa.array(size, pa.int64())],
            ["text", "seg_chars", "seg_tokens", "n_tokens",
             "n_edits", "segments_encoded", "n_segments"])

    return edited(state, edits)


def build_state(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with `token_state`; write it as a table to keep it between
    batches of edits. Narrow, no shuffle."""
    tokenizer = read_tokenizer(docs.sparkSession, path)
    return docs.withColumn("token_state", state_column(tokenizer, F.col(f"`{text}`")))


def apply_edits(state: DataFrame, path: str, edits: str = "edits") -> DataFrame:
    """`token_state` after the row's list of edits (in order)."""
    tokenizer = read_tokenizer(state.sparkSession, path)
    return state.withColumn("token_state", edited_column(
        tokenizer, F.col("token_state"), F.col(f"`{edits}`")))


def derived_edits(text: Column, key: Column) -> Column:
    """Three edits that follow from the row: replace, insert and delete at
    places given by hashes of the key; inserted text comes from the text."""
    n = F.length(text)
    def at(what: str, k: int, most: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(what), F.lit(k), key), most)
    one = []
    for k, (cut, put) in enumerate(((20, 30), (0, 25), (40, 0))):
        length = at("cut", k, F.lit(cut + 1)) if cut else F.lit(0).cast("long")
        source = F.substring(text, at("from", k, n + 1).cast("int") + 1,
                             at("size", k, F.lit(put + 1)).cast("int"))
        one.append(F.struct(at("start", k, n + 1).cast("long").alias("start"),
                            length.cast("long").alias("length"),
                            (source if put else F.lit("")).alias("replacement")))
    return F.array(*one).cast(EDITS)


def count_query(docs: DataFrame, path: str) -> DataFrame:
    """Counts of every document before and after its derived edits."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "text", derived_edits(text, F.col("doc_id")).alias("edits"))
    before = build_state(rows, path).withColumn("n_before", F.col("token_state.n_tokens"))
    after = apply_edits(before, path)
    return after.select(
        "doc_id", F.col("n_before").alias("n_tokens_before"),
        F.col("token_state.n_tokens").alias("n_tokens"),
        F.col("token_state.n_edits").alias("n_edits"),
        F.col("token_state.segments_encoded").alias("segments_encoded"),
        F.col("token_state.n_segments").alias("n_segments"),
        F.length("token_state.text").cast("long").alias("n_chars_after"),
        F.aggregate("token_state.seg_tokens", F.lit(0).cast("long"),
                    lambda a, x: a + x).alias("n_tokens_of_segments"))
