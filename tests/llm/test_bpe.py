"""Operators 1 and 2 against the tokenizers library and full recounts."""

import hashlib
import json
import random
import unicodedata
from array import array

import numpy as np
from tokenizers import Tokenizer

from retentio.llm import bpe, token_counts

from .conftest import SF

ODD = [None, "", " ", "\n\t", "a", "<|endoftext|>", "x<|startoftext|>Y <|ENDOFTEXT|>z",
       "it's they'LL 1234 ½ é é ΣΑΣ İ ﬁ 日本 🙂👍🏽 \x1c\x1d x\x85y", "ab" * 5000,
       " a b　", "-" * 300, "zq" + "x" * 77]


def _library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation(), t.no_padding()
    return t


def test_random_strings_equal_the_library(tokenizer):
    own, lib = bpe.model_of(open(tokenizer, encoding="utf-8").read()), _library(tokenizer)
    r = random.Random(7)
    for k in range(3000):
        alphabet = ("abn", "aeinst' ", "abcdefghijklmnopqrstuvwxyz", "eéß’'.,!?09 \nñÇ日한🙂́")[k % 4]
        s = "".join(r.choice(alphabet) for _ in range(r.choice([1, 2, 5, 9, 20, 60])))
        ids = lib.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(s), dtype="<u4").tolist() == ids, s
        assert own.decode(own.encode(s)) == lib.decode(ids, skip_special_tokens=False)


def test_every_code_point_and_mark_equals_the_library(tokenizer):
    """Each code point between letters, and each after a letter that an
    accent follows."""
    library = Tokenizer.from_file(tokenizer)
    with open(tokenizer, encoding="utf-8") as f:
        own = bpe.WordBpe(f.read())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}B" for c in points[i:i + 2000]) for i in range(0, len(points), 2000)]
    marks = [c for c in points if unicodedata.combining(c) or 0x300 <= ord(c) < 0x1B00 or "\u1dc0" <= c < "\u2100"]
    texts += [" ".join(f"a{c}\u0301e\u0327{c}" for c in marks[i:i + 2000]) for i in range(0, len(marks), 2000)]
    for text in texts:
        want = array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
        if own.encode(text) != want:
            bad = [w for w in text.split(" ") if own.encode(w) != array(
                "I", library.encode(w, add_special_tokens=False).ids).tobytes()]
            assert not bad, [hex(ord(w[1])) for w in bad[:20]]


def test_every_token_encodes_to_itself(tokenizer):
    own = bpe.model_of(open(tokenizer, encoding="utf-8").read())
    back = {c: b for b, c in enumerate(bpe.byte_symbols())}
    closed = [(i, t[:-4]) for i, t in own.text.items()
              if t.endswith("</w>") and t not in own.special]
    assert len(closed) > 20000
    for i, t in closed:
        assert own.word(bytes(back[c] for c in t)) == [i]


def test_query_equals_the_library(spark, tokenizer):
    lib = _library(tokenizer)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in bpe.digest_query(docs, tokenizer).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        text = lib.decode(ids, skip_special_tokens=False)
        assert g["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_edge_rows(docs, tokenizer):
    lib = _library(tokenizer)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (3, "a b"), (3, "a b")]
    out = bpe.encode_documents(docs(rows), tokenizer).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["token_ids"]), dtype="<u4").tolist() == ids
        assert r["decoded_text"] == lib.decode(ids, skip_special_tokens=False)
    assert bpe.digest_query(docs([]).select("doc_id", "text"), tokenizer).count() == 0


def test_edits_equal_a_full_recount(docs, tokenizer):
    own = bpe.model_of(open(tokenizer, encoding="utf-8").read())
    r = random.Random(3)
    for text in [t or "" for t in ODD] + ["one two  three\n\nfour " * 40]:
        parts = token_counts.segments(text)
        assert "".join(parts) == text
        tree = token_counts.SegmentTree(text, list(map(len, parts)),
                                        token_counts.counts(own, parts))
        for _ in range(12):
            start, cut = r.randint(0, len(text) + 3), r.choice([0, 0, 1, 3, 40, 10 ** 6])
            new = r.choice(["", " ", "x", "mid dle", "\n", "<|endoftext|>", "tail "])
            tree.edit(own, start, cut, new)
            at = min(start, len(text))
            text = text[:at] + new + text[at + cut:]
            assert tree.text == text
            assert tree.segments().sum(axis=0).tolist() == tree.sums[1].tolist()
            assert tree.sums[1, 0] == len(text)
            assert tree.sums[1, 1] == len(own.encode(text)) // 4


def test_count_query(spark, docs, tokenizer):
    own = bpe.model_of(open(tokenizer, encoding="utf-8").read())
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = token_counts.count_query(rows, tokenizer)
    full = {r["doc_id"]: len(own.encode(r["text"])) // 4 for r in rows.collect()}
    got = out.collect()
    assert len(got) == len(full)
    assert all(g["n_tokens_before"] == full[g["doc_id"]] for g in got)
    assert all(g["n_tokens"] == g["n_tokens_of_segments"] and g["n_edits"] == 3 for g in got)
    big = [g for g in got if g["n_segments"] > 200]
    assert big and all(g["segments_encoded"] < 60 for g in big)
    # the edited text is the state's own: recount it whole
    from pyspark.sql import functions as F
    text = F.coalesce(F.col("text"), F.lit(""))
    state = token_counts.build_state(rows.withColumn(
        "edits", token_counts.derived_edits(text, F.col("doc_id"))), tokenizer)
    for r in token_counts.apply_edits(state, tokenizer).collect():
        t = r["text"]
        for e in r["edits"]:
            at = min(e["start"], len(t))
            t = t[:at] + e["replacement"] + t[at + e["length"]:]
        assert r["token_state"]["text"] == t
        assert r["token_state"]["n_tokens"] == len(own.encode(t)) // 4
    odd = token_counts.count_query(docs([(i, t) for i, t in enumerate(ODD)] + [(None, "x")]),
                                   tokenizer).collect()
    assert len(odd) == len(ODD) + 1
    assert token_counts.count_query(docs([]), tokenizer).count() == 0


def test_idle_workers_hold_no_tables(spark, docs, tokenizer, tmp_path):
    """Later stages run beside the Python workers that encoded."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    mark = "<|only here|>"
    spec["added_tokens"].append({**spec["added_tokens"][0], "content": mark, "id": 60_000})
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    rows = docs([(i, f"word{i} of {mark}") for i in range(64)]).repartition(8)
    out = bpe.encode_documents(rows, str(path)).collect()
    assert len(out) == 64 and all(r["decoded_text"].endswith(mark) for r in out)

    def held(batches):
        import gc

        gc.collect()
        n = sum(isinstance(x, bpe.WordBpe) and mark in x.special for x in gc.get_objects())
        for batch in batches:
            yield batch.assign(n=n)

    found = spark.range(0, 64, 1, 16).mapInPandas(held, "id long, n long").collect()
    assert len(found) == 64 and not any(r["n"] for r in found)


def test_encoding_keeps_the_input_columns(spark, tokenizer):
    rows = spark.createDataFrame([(1, "a b", "x", "y"), (2, None, None, "z")],
                                 "doc_id long, text string, _coded string, token_ids string")
    for decoded in ("decoded_text", None):
        out = bpe.encode_documents(rows, tokenizer, decoded=decoded)
        assert out.columns == rows.columns + ([decoded] if decoded else [])
        got = {r["doc_id"]: r for r in out.collect()}
        assert [got[i]["_coded"] for i in (1, 2)] == ["x", None]
        assert len(got[1]["token_ids"]) == 8 and len(got[2]["token_ids"]) == 0
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
