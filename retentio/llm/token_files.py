"""Operator 13: token ids in binary files with constant-time keyed access.

Layout of a folder of token files (all numbers little-endian):

* `data/*.ids`: raw unsigned ids, documents one after another, each with
  the end id. An id has two bytes where the vocabulary and the end id fit,
  else four (`width` in the shard table). Documents stand in ascending key
  order over the files; a file is closed at the first document border after
  SHARD_BYTES.
* `data/*.off`: unsigned 64-bit offsets (in ids) of the file's documents,
  one more than there are documents.
* `index/*.mph`: the keys of one hash bucket: a minimal perfect hash
  (`perfect_hash`) and, in slot order, one entry per key: 64-bit
  fingerprint, first and last shard, first document in the first, end in
  the last. A key that repeats is one entry: its documents are neighbours.
* `shards`, `buckets`: Parquet tables that name the files. They are written
  by Spark's committer and name the files of successful tasks only, so
  what a lost or repeated task left behind is never read.

A key is found by: hash, bucket file, slot, fingerprint, entry, offsets,
payload; no search over keys. Reading many keys at once is a Spark job of
the same steps; a task of it reads one index file or shard after another.

A key is the text form of the key column (null included); two 64-bit
hashes stand for it, one of them is the stored fingerprint.

Defined cases: null and empty texts hold the end id alone; a null key sorts
first and is a key like any other; rows that repeat a key or the whole row
are documents of their own, in input order; a key that is not filed gives
no document; a long document is written and read whole; an empty table
gives an empty folder. Other columns are not stored. The folder must be
shared storage that pyarrow's file systems reach.
"""

from __future__ import annotations

import io
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retentio.plans.lookup import lookup_join
from retentio.plans.prefix import running_totals
from retentio.plans.tables import materialize, scratch_path

from .bpe import read_tokenizer
from .perfect_hash import PerfectHash, words64
from .token_encoder import encoder_of

END_ID = 1
SHARD_BYTES = 32 << 20
KEYS_PER_INDEX = 16_384
#: bytes of ids that a reading task holds at once, unless one document has more
READ_BYTES = 2 << 20

MAGIC = b"TOKMPH01"
ENTRY = np.dtype([("fingerprint", "<u8"), ("first_shard", "<u4"), ("last_shard", "<u4"),
                  ("first_doc", "<u4"), ("end_doc", "<u4")])
PIECE = "part int, seq int, file string, key string, first_doc int, n_docs int, n_ids long"
FOUND = ("key string, first_shard long, last_shard long, first_doc long, end_doc long")
DOCUMENT = "key string, start long, n_tokens long, token_ids binary"


def key_hashes(key: Column) -> list[Column]:
    """The two hashes of a key, as `hashes_of` computes them."""
    return [F.xxhash64(key).alias("k1"), F.xxhash64(key, key).alias("k2")]


def hashes_of(key: str | None) -> tuple[int, int]:
    """k1, k2 (signed) of one key, outside Spark."""
    k1 = k2 = 42
    if key is not None:
        data = key.encode()
        k1 = xxhash.xxh64_intdigest(data, 42)
        k2 = xxhash.xxh64_intdigest(data, k1)
    return tuple(k - (1 << 64) if k >> 63 else k for k in (k1, k2))


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def _write(path: str, data) -> None:
    fs, p = _fs(path)
    with fs.open_output_stream(p) as f:
        f.write(data)


class _Shard:
    """One file pair on its way; pieces are the keys in it."""

    def __init__(self, folder: str, part: int, seq: int, width: int):
        self.name = f"{folder}/{part:08d}-{seq:06d}-{uuid.uuid4().hex}"
        self.part, self.seq, self.width = part, seq, width
        fs, p = _fs(f"{self.name}.ids")
        self.out = fs.open_output_stream(p)
        self.offsets, self.pieces = [0], []

    def add(self, key: str | None, ids: bytes) -> None:
        """`ids` have four bytes each."""
        self.out.write(ids if self.width == 4 else np.frombuffer(ids, "<u4").astype("<u2"))
        n = len(ids) // 4
        self.offsets.append(self.offsets[-1] + n)
        if self.pieces and self.pieces[-1][0] == key:
            self.pieces[-1][2] += 1
            self.pieces[-1][3] += n
        else:
            self.pieces.append([key, len(self.offsets) - 2, 1, n])

    def full(self, size: int) -> bool:
        return self.width * self.offsets[-1] >= size

    def close(self) -> pa.RecordBatch:
        self.out.close()
        _write(f"{self.name}.off", np.array(self.offsets, dtype="<u8").tobytes())
        key, first, docs, ids = zip(*self.pieces)
        n = len(key)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.part] * n, pa.int32()), pa.array([self.seq] * n, pa.int32()),
             pa.array([self.name] * n), pa.array(key, pa.string()), pa.array(first, pa.int32()),
             pa.array(docs, pa.int32()), pa.array(ids, pa.int64())],
            ["part", "seq", "file", "key", "first_doc", "n_docs", "n_ids"])


def _writer(tokenizer, folder: str, end_id: int, shard_bytes: int, width: int):
    end = end_id.to_bytes(4, "little")

    def write(batches):
        encoder, shard, seq = encoder_of(tokenizer.value), None, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = shard or _Shard(folder, part, seq, width)
                shard.add(key, encoder.encode(text) + end)
                if shard.full(shard_bytes):
                    yield shard.close()
                    shard, seq = None, seq + 1
        if shard:
            yield shard.close()

    return write


def write_index(path: str, k1: np.ndarray, k2: np.ndarray, entries: np.ndarray) -> None:
    """One bucket's hash and its entries in slot order."""
    index = PerfectHash.build(k1, k2)
    ordered = np.empty(len(k1), dtype=ENTRY)
    ordered[index.slots(k1, k2)] = entries
    head = np.array([len(k1), len(index.sizes), *index.sizes], dtype="<u8").tobytes()
    _write(path, b"".join([MAGIC, head, index.bits.tobytes(), ordered.tobytes()]))


class Index:
    """An index file: the hash is held, an entry is read where it stands."""

    def __init__(self, path: str):
        fs, p = _fs(path)
        self.file = fs.open_input_file(p)
        head = io.BytesIO(self.file.read_at(len(MAGIC) + 16 + 8 * 64, 0))
        if head.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"not an index file: {path}")
        self.n, levels = (int(x) for x in np.frombuffer(head.read(16), "<u8"))
        sizes = [int(x) for x in np.frombuffer(head.read(8 * levels), "<u8")]
        at, size = head.tell(), 8 * sum(sizes)
        self.hash = PerfectHash(sizes, np.frombuffer(self.file.read_at(size, at), "<u8"))
        self.entries_at = at + size

    def entry(self, k1: int, k2: int) -> np.void | None:
        a, b = words64([k1]), words64([k2])
        slot = int(self.hash.slots(a, b)[0])
        if slot < 0:
            return None
        raw = self.file.read_at(ENTRY.itemsize, self.entries_at + ENTRY.itemsize * slot)
        found = np.frombuffer(raw, ENTRY)[0]
        return found if found["fingerprint"] == b[0] else None

    def entries(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of many keys are filed, and their entries."""
        held = np.frombuffer(self.file.read_at(ENTRY.itemsize * self.n, self.entries_at), ENTRY)
        slots = self.hash.slots(k1, k2)
        known = slots >= 0
        known[known] = held["fingerprint"][slots[known]] == k2[known]
        return known, held[slots[known]]


def _index_builder(folder: str):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        entries = np.empty(len(rows), dtype=ENTRY)
        k1, k2 = words64(rows["k1"]), words64(rows["k2"])
        entries["fingerprint"] = k2
        for name in ENTRY.names[1:]:
            entries[name] = rows[name]
        path = f"{folder}/{uuid.uuid4().hex}.mph"
        write_index(path, k1, k2, entries)
        return pd.DataFrame({"bucket": rows["bucket"][:1], "file": [path], "n_keys": [len(rows)]})

    return build


def _index_reader(batches):
    """Rows (bucket, file, key, k1, k2), sorted by bucket, to their entries."""
    name = index = None
    for batch in batches:
        files = np.array(batch.column("file").to_pylist(), dtype=object)
        k1, k2 = words64(batch.column("k1").to_numpy()), words64(batch.column("k2").to_numpy())
        borders = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1), len(files)]
        for a, b in zip(borders, borders[1:]):
            if a == b:
                continue
            if files[a] != name:
                name, index = files[a], Index(files[a])
            known, entries = index.entries(k1[a:b], k2[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(a, b - a).filter(pa.array(known))]
                + [pa.array(entries[c].astype(np.int64)) for c in ENTRY.names[1:]],
                ["key", *ENTRY.names[1:]])


def _wide(raw: bytes, width: int) -> bytes:
    """Stored ids as four bytes each."""
    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def _documents(key: str | None, offsets: np.ndarray, start: int, payload, at: int):
    """A record batch of neighbouring documents; `payload` holds their ids."""
    ids = [payload[4 * (a - at):4 * (b - at)] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array([key] * n, pa.string()), pa.array(offsets[:-1].astype(np.int64) + start),
         pa.array(np.diff(offsets).astype(np.int64)), pa.array(ids, pa.binary())],
        ["key", "start", "n_tokens", "token_ids"])


def _payload_reader(batches):
    """Rows (file, start, width, key, from_doc, to_doc), sorted by file, to documents."""
    name = ids = offsets = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in
                   ("file", "start", "width", "key", "from_doc", "to_doc")]
        ready, size = [], 0
        for file, start, width, key, first, end in zip(*columns):
            if file != name:
                name, (fs, p) = file, _fs(file)
                ids = fs.open_input_file(f"{p}.ids")
                with fs.open_input_file(f"{p}.off") as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
            end = len(offsets) - 1 if end is None else end
            while first < end:
                # as many documents as fit, one at least
                last = int(np.searchsorted(offsets, offsets[first] + READ_BYTES // 4, "right")) - 1
                last = min(max(last, first + 1), end)
                at, stop = int(offsets[first]), int(offsets[last])
                raw = _wide(ids.read_at(width * (stop - at), width * at), width)
                ready.append(_documents(key, offsets[first:last + 1], start, raw, at))
                size, first = size + len(raw), last
                if size >= READ_BYTES:
                    yield _joined(ready)
                    ready, size = [], 0
        if ready:
            yield _joined(ready)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


@dataclass
class TokenFiles:
    """A written folder. `shards` (shard, file, n_docs, n_ids, start) and
    `buckets` (bucket, file, n_keys) are tables; `n_buckets` counts them."""

    spark: SparkSession
    path: str

    @property
    def shards(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/shards")

    @property
    def buckets(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/buckets")

    def find(self, keys: DataFrame, key: str = "key") -> DataFrame:
        """key, shard, from_doc, to_doc: where the documents of the different
        keys stand; to_doc is null where they go on to the shard's end."""
        n = self.buckets.agg(F.sum("bucket_count")).first()[0]
        if not n:
            return self.spark.createDataFrame([], "key string, shard long, from_doc long, to_doc long")
        k = F.col(f"`{key}`").cast("string")
        asked = keys.select(k.alias("key")).distinct().select("key", *key_hashes(F.col("key")))
        asked = asked.withColumn("bucket", F.pmod("k1", F.lit(n)))
        named = lookup_join(asked, self.buckets.filter("file IS NOT NULL").select("bucket", "file"),
                            "bucket", "inner", ["k2"])
        # one bucket holds about KEYS_PER_INDEX keys: no task gets many at once
        found = (named.repartition("bucket").sortWithinPartitions("bucket")
                 .mapInArrow(_index_reader, FOUND))
        first, last = F.col("first_shard"), F.col("last_shard")
        return found.withColumn("shard", F.explode(F.sequence(first, last))).select(
            "key", "shard",
            F.when(F.col("shard") == first, F.col("first_doc")).otherwise(0).alias("from_doc"),
            F.when(F.col("shard") == last, F.col("end_doc")).alias("to_doc"))

    def read(self, keys: DataFrame, key: str = "key") -> DataFrame:
        """key (text form), start, n_tokens, token_ids of every document of
        the given keys."""
        places = lookup_join(self.find(keys, key), self.shards.select("shard", "file", "start", "width"),
                             "shard", "inner", ["key", "from_doc"])
        # a shard is bounded by SHARD_BYTES and one document
        return (places.select("file", "start", "width", "key", "from_doc", "to_doc", "shard")
                .repartition("shard").sortWithinPartitions("shard", "from_doc")
                .mapInArrow(_payload_reader, DOCUMENT))

    def get(self, key) -> list[np.ndarray]:
        """Ids of one key's documents, read by this process alone."""
        k1, k2 = hashes_of(None if key is None else str(key))
        shards, buckets = _manifest(self.path)
        file = buckets[k1 % len(buckets)] if buckets else None
        entry = _open_index(file).entry(k1, k2) if file else None
        if entry is None:
            return []
        out = []
        for s in range(int(entry["first_shard"]), int(entry["last_shard"]) + 1):
            out += self._shard_documents(
                shards[s], int(entry["first_doc"]) if s == entry["first_shard"] else 0,
                int(entry["end_doc"]) if s == entry["last_shard"] else None)
        return out

    @staticmethod
    def _shard_documents(shard: tuple[str, int], first: int, end: int | None) -> list[np.ndarray]:
        file, width = shard
        fs, p = _fs(file)
        with fs.open_input_file(f"{p}.off") as f, fs.open_input_file(f"{p}.ids") as ids:
            end = f.size() // 8 - 1 if end is None else end
            at = np.frombuffer(f.read_at(8 * (end - first + 1), 8 * first), "<u8").tolist()
            return [np.frombuffer(ids.read_at(width * (b - a), width * a), f"<u{width}")
                    for a, b in zip(at, at[1:])]


@lru_cache(maxsize=4)
def _manifest(path: str) -> tuple[list[tuple[str, int]], list[str]]:
    """(file, width) of shards and index files, by number: one per file."""
    def table(name: str, columns: list[str]) -> list[list]:
        fs, p = _fs(f"{path}/{name}")
        rows = pq.read_table(p, filesystem=fs, columns=columns).sort_by(columns[0])
        return [rows[c].to_pylist() for c in columns[1:]]

    return (list(zip(*table("shards", ["shard", "file", "width"]))),
            table("buckets", ["bucket", "file"])[0])


@lru_cache(maxsize=64)
def _open_index(path: str) -> Index:
    return Index(path)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id",
                      text: str = "text", end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
                      keys_per_index: int = KEYS_PER_INDEX) -> TokenFiles:
    """Encode every document and write the folder at `path`.

    One range exchange puts the texts in key order (a key of any number of
    rows spreads over ranges by its rows' places in the input); ids are
    made and written by the same task. The index is one shuffle of keys.
    """
    spark = docs.sparkSession
    path = path.rstrip("/")
    for name in ("data", "index"):
        fs, p = _fs(f"{path}/{name}")
        fs.create_dir(p, recursive=True)
    tokenizer = read_tokenizer(spark, tokenizer_path)
    most = max(end_id, *Tokenizer.from_str(tokenizer.value).get_vocab().values())
    width = 2 if most < 1 << 16 else 4
    k = F.col(f"`{key}`")
    order = [F.col("o").asc_nulls_first(), F.col("at")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(k.alias("o"), F.col(f"`{text}`").alias("text"))
            .withColumn("at", F.monotonically_increasing_id())
            .repartitionByRange(ranges, *order).sortWithinPartitions(*order)
            .select(F.col("o").cast("string").alias("key"), "text"))
    pieces = materialize(
        rows.mapInArrow(_writer(tokenizer, f"{path}/data", end_id, shard_bytes, width), PIECE),
        "pieces", f"{path}/pieces")
    by_file = pieces.groupBy("part", "seq", "file").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_ids").alias("n_ids"))
    placed = running_totals(by_file, [F.col("part"), F.col("seq")], ["n_ids"], index="shard")
    shards = materialize(placed.select(
        F.col("shard").cast("long").alias("shard"), "part", "seq", "file", "n_docs", "n_ids",
        F.lit(width).alias("width"), (F.col("cum_n_ids") - F.col("n_ids")).alias("start")), "shards", f"{path}/shards")
    here = F.struct("shard", "first_doc")
    end = F.struct("shard", (F.col("first_doc") + F.col("n_docs")).alias("end_doc"))
    keyed = materialize(
        lookup_join(pieces.select("part", "seq", "key", "first_doc", "n_docs"),
                    shards.select("part", "seq", "shard"), ["part", "seq"], "inner", ["key"])
        .groupBy("key").agg(F.min(here).alias("a"), F.max(end).alias("b"))
        .select(*key_hashes(F.col("key")), F.col("a.shard").alias("first_shard"),
                F.col("b.shard").alias("last_shard"), "a.first_doc", "b.end_doc"), "keyed")
    n = -(-keyed.count() // keys_per_index)
    buckets = (keyed.withColumn("bucket", F.pmod("k1", F.lit(max(1, n)))).groupBy("bucket")
               .applyInPandas(_index_builder(f"{path}/index"), "bucket long, file string, n_keys long"))
    # a bucket that no key fell into has no file and is numbered by its absence
    made = materialize(buckets, "buckets_made")
    full = spark.range(n).withColumnRenamed("id", "bucket").join(made, "bucket", "left")
    materialize(full.withColumn("bucket_count", F.lit(1)), "buckets", f"{path}/buckets")
    return TokenFiles(spark, path)


def token_file_query(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from its files."""
    rows = docs.select("doc_id", "text")
    files = write_token_files(rows, scratch_path(docs.sparkSession, "token_files"), tokenizer_path)
    kind = docs.schema["doc_id"].dataType
    return files.read(rows, "doc_id").select(
        F.col("key").cast(kind).alias("doc_id"), "start", "n_tokens",
        F.crc32("token_ids").alias("ids_crc32"))
