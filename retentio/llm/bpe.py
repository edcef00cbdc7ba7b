"""Operator 1: exact BPE encoding and decoding.

Method: per-prefix dynamic programming. A word is a string over 512 symbols
(256 bytes, and 256 bytes that end a word). Merges define one canonical
split for every prefix, so a prefix is described by its last token alone.
At each position an automaton lists the vocabulary tokens that end there;
the one whose left neighbour (the last token of the shorter prefix) is
compatible with it is the last token. Following the back-pointers from the
end gives the ids. Cost is linear in the word, whatever its length.

Two tokens are compatible when undoing their merges in reverse order never
meets a merge across their border that would have come first.

A document is cut at white space; each piece is normalised and cut into
pre-tokens as the tokenizer file says, and its ids are kept in a bounded
memo (a cache only: a miss recomputes the same ids). Tables and memo live as
long as a task: an idle Python worker, which later stages keep, holds none.

Which code points are letters, which compose and what they lower to differs
between Unicode versions. Below U+0250 Python and the tokenizers library
agree; a piece with any other code point is normalised and cut into
pre-tokens by the library's own tables. Its ids come from the method above.

Nulls encode like the empty text. Special tokens in a text become their
own ids, as the tokenizers library does by default.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import bounded_batches

#: entries of a task's memo (in two generations), some 200 bytes each
MEMO = 200_000
#: token pairs known to be compatible or not; forgotten when full
PAIRS = 400_000

# Fixed value: white space as the tokenizer's patterns see it.
SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
         "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_SPACES = re.compile(f"[{SPACE}]+")
PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")
_ODD = re.compile("[\x1c-\x1f]")     # Python splits at these, the tokenizer does not


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    own = {b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)}
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Memo:
    """Two generations of recent entries; older ones are forgotten."""

    def __init__(self, size: int):
        self.size, self.recent, self.older = size, {}, {}

    def get(self, key: str) -> bytes | None:
        value = self.recent.get(key)
        if value is None:
            value = self.older.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key: str, value: bytes) -> None:
        if len(key) > 64:
            return
        if len(self.recent) >= self.size:
            self.older = dict(self.recent)
            self.recent.clear()
        self.recent[key] = value


class WordBpe:
    """Tables of one tokenizer file (word-end BPE)."""

    def __init__(self, document: str):
        spec = json.loads(document)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.text = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text.update({i: t for t, i in self.special.items()})
        # by id, for whole documents at once
        self.by_id = np.empty(max(self.text) + 1, dtype=object)
        self.by_id[list(self.text)] = list(self.text.values())
        self.special_re = re.compile("(" + "|".join(
            re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.pieces = regex.compile(next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"))
        # the library's own normaliser and cutter, without its vocabulary
        self.library = Tokenizer.from_str(json.dumps(
            {**spec, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}))
        symbols = byte_symbols()
        self.back = back = {c: b for b, c in enumerate(symbols)}
        # merges in order: rank of the token each makes, and its two parts
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {i: -1 for i in self.text}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.rank_of_pair[left, right] = r
            self.parts[made] = (left, right)
            self.rank[made] = r
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if token in self.special:
                continue
            closed = token.endswith(self.end) and token != self.end
            body = [back[c] for c in (token[:-len(self.end)] if closed else token)]
            if closed:
                body[-1] += 256
            self.automaton.add_word("".join(map(chr, body)), (i, len(body)))
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        # a piece that is one pre-token has that pre-token's ids: one memo for both
        self._memo = Memo(MEMO // 2)

    # -- the dynamic programme -------------------------------------------
    def compatible(self, left: int, right: int) -> bool:
        """True when merging leaves the border between the two as it is."""
        a, b = left, right
        limit = 1 << 60                   # a border merge below it comes first
        while True:
            across = self.rank_of_pair.get((a, b))
            if across is not None and across < limit:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            # undo the later merge; of equal merges the left one came first
            if ra > rb:
                limit, a = ra, self.parts[a][1]
            else:
                limit, b = rb + 1, self.parts[b][0]

    def word(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        s = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        last, back, known = [-1] * len(s), [0] * len(s), self._pairs
        done = -1
        for at, (token, n) in self.automaton.iter(s):
            if at == done:
                continue
            start = at - n
            if start >= 0:
                left = last[start]
                pair = left << 20 | token
                good = known.get(pair)
                if good is None:
                    if len(known) >= PAIRS:
                        known.clear()
                    good = known[pair] = self.compatible(left, token)
                if not good:
                    continue
            last[at], back[at], done = token, start, at
        out, at = [], len(s) - 1
        while at >= 0:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    def words(self, raw: str) -> list[str]:
        """Pre-tokens of a stretch without white space or special tokens."""
        if raw.isascii():
            text = raw.lower()
            return [text] if text.isalpha() else self.pieces.findall(text)
        if PLAIN.fullmatch(raw):               # composed already
            return self.pieces.findall(raw.lower())
        normal = self.library.normalizer.normalize_str(raw)
        cut = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(map(self.back.__getitem__, symbols)).decode() for symbols, _ in cut]

    def piece(self, raw: str) -> bytes:
        """Ids of a stretch without white space or special tokens."""
        ids = self._memo.get(raw)
        if ids is not None:
            return ids
        words = self.words(raw)
        found = []
        for w in words:
            ids = self._memo.get(w)
            if ids is None:
                ids = array("I", self.word(w.encode("utf-8"))).tobytes()
                self._memo.put(w, ids)
            found.append(ids)
        if len(words) == 1 and words[0] == raw:
            return ids
        ids = b"".join(found)
        self._memo.put(raw, ids)
        return ids

    # -- documents --------------------------------------------------------
    def split(self, text: str) -> list[str]:
        if _ODD.search(text):
            return [p for p in _SPACES.split(text) if p]
        return text.split()

    def stretches(self, text: str) -> list[str]:
        """Special tokens (odd places) and what stands between them."""
        return self.special_re.split(text) if "<|" in text else [text]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for k, part in enumerate(self.stretches(text or "")):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            recent = self._memo.recent
            out += [recent.get(p) or self.piece(p) for p in self.split(part)]
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """The file names no decoder: tokens are joined by one space."""
        if not ids:
            return ""
        return " ".join(self.by_id[np.frombuffer(ids, dtype="<u4")].tolist())


@lru_cache(maxsize=2)
def model_of(document: str) -> WordBpe:
    return WordBpe(document)


def read_tokenizer(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast string; its size is the size of the
    vocabulary file (1.7 MB), whatever the corpus."""
    bounded_batches(spark)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_column(tokenizer, text: Column, decoded: bool = True) -> Column:
    """struct(ids, decoded) of a text column: ids as binary (little-endian
    unsigned 32-bit) and the text they decode to (null if not asked for)."""
    @F.pandas_udf("ids binary, decoded string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = None
        for texts in batches:
            model = model or WordBpe(tokenizer.value)
            ids = [model.encode(t) for t in texts]
            back = [model.decode(b) if decoded else None for b in ids]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                                "decoded": pd.Series(back, dtype=object)})

    return encode(text)


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids",
                     decoded: str | None = "decoded_text") -> DataFrame:
    """`docs` with `ids` (binary, 4 bytes per token) and the decoded text.

    One narrow stage: no shuffle, rows stay where they are. Columns of the
    input with these names are replaced. Null and empty texts give no ids
    and an empty decoded text; an empty table gives an empty table.
    """
    tokenizer = read_tokenizer(docs.sparkSession, path)
    held = "_coded"
    while held in map(str.lower, docs.columns):
        held += "_"
    out = (docs.withColumn(held, encode_column(tokenizer, F.col(f"`{text}`"), bool(decoded)))
           .withColumn(ids, F.col(held)["ids"]))
    if decoded:
        out = out.withColumn(decoded, F.col(held)["decoded"])
    return out.drop(held)


def digest_query(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    out = encode_documents(docs.select("doc_id", "text"), path)
    return out.select(
        "doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256"))
