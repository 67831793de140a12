"""Token ids in raw shards with a minimal perfect hash index over the document keys.

Shard files hold nothing but ids, two or four bytes each, documents in ascending doc_id order. Index files, by the key's hash,
map a key to its shard, offset and length: hash and displace gives each key of a file a slot of its own, with no slot left over,
and a stored fingerprint tells keys that aren't there. A lookup reads one displacement and one slot.

All files lie in a folder that every executor reaches; they are written under another name and then renamed, so a task that runs
twice leaves one file.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, saved, shared_dir
from .encoder import default_vocabulary, encoded, encoder

END_ID = 2
#: Keys of an index file, on average.
INDEX_KEYS = 32768
_MAGIC = b"MPHIDX1\0"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, blobs) -> None:
    f, path = _fs(uri)
    part = f"{path}.{uuid.uuid4().hex}"
    f.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with f.open_output_stream(part) as out:
        for b in blobs:
            out.write(b)
    f.move(part, path)


# --- minimal perfect hash -------------------------------------------------------------------------------------------


def _slots(keys: np.ndarray, d, n: int) -> np.ndarray:
    return (mix(keys ^ (np.uint64(0x9E3779B97F4A7C15) * (np.asarray(d, np.uint64) + np.uint64(1)))) % np.uint64(n)).astype(np.int64)


def _buckets(keys: np.ndarray, m: int) -> np.ndarray:
    return (mix(keys + np.uint64(0xD1B54A32D192ED03)) % np.uint64(m)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def build(keys: np.ndarray) -> np.ndarray:
    """Displacements of distinct keys (uint64): buckets of four keys on average, the largest first, each with the first
    displacement that puts its keys into free slots; a bucket of one key names its slot itself, as -1 - slot."""
    n = len(keys)
    m = max(1, -(-n // 4))
    if len(np.unique(keys)) != n:
        raise ValueError("keys of an index must be distinct")
    bucket = _buckets(keys, m)
    order = np.argsort(bucket, kind="stable")
    first = np.searchsorted(bucket[order], np.arange(m + 1))
    sizes = np.diff(first)
    taken, g = np.zeros(n, bool), np.zeros(m, np.int64)
    tries = np.arange(32, dtype=np.uint64)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        own, base = keys[order[first[b] : first[b + 1]]], 0
        while True:
            s = np.sort(_slots(own[None, :], tries[:, None] + np.uint64(base), n), axis=1)
            good = ~taken[s].any(1) & (s[:, 1:] != s[:, :-1]).all(1)
            if good.any():
                k = int(good.argmax())
                taken[s[k]] = True
                g[b] = base + k
                break
            base += len(tries)
    ones = np.flatnonzero(sizes == 1)
    g[ones] = -1 - np.flatnonzero(~taken)[: len(ones)]
    return g


def slot_of(keys: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    d = g[_buckets(keys, len(g))]
    return np.where(d < 0, -1 - d, _slots(keys, np.maximum(d, 0), n))


def index_bytes(keys: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray) -> bytes:
    g, n = build(keys), len(keys)
    at = slot_of(keys, g, n)
    out = [np.zeros(n, "<u4"), np.zeros(n, "<i4"), np.zeros(n, "<i8"), np.zeros(n, "<i8")]
    for a, x in zip(out, (fingerprint(keys), shard, offset, length), strict=True):
        a[at] = x
    return _MAGIC + struct.pack("<qq", n, len(g)) + g.astype("<i8").tobytes() + b"".join(a.tobytes() for a in out)


class Index:
    """An index file: find() gives (found, shard, offset, length) of keys."""

    def __init__(self, data):
        data = memoryview(data)
        if bytes(data[:8]) != _MAGIC:
            raise ValueError("not an index file")
        self.n, m = struct.unpack("<qq", data[8:24])
        at = 24
        self.g = np.frombuffer(data, "<i8", m, at)
        at += 8 * m
        cols = []
        for kind in ("<u4", "<i4", "<i8", "<i8"):
            cols.append(np.frombuffer(data, kind, self.n, at))
            at += self.n * np.dtype(kind).itemsize
        self.print, self.shard, self.offset, self.length = cols

    def find(self, keys: np.ndarray):
        s = slot_of(keys, self.g, self.n)
        return self.print[s] == fingerprint(keys), self.shard[s], self.offset[s], self.length[s]


# --- writing --------------------------------------------------------------------------------------------------------


def _by_group(batches, names: list[str]):
    """(group, columns) of rows that come sorted by their first column."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and k[a] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = k[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def write_store(docs: DataFrame, folder: str, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> int:
    """Writes shards and index into `folder`; returns the number of index files.

    Null or empty text: only the end id. Documents of equal doc_id follow each other by text and are keyed by (doc_id, nth);
    null doc_ids come first. An empty table makes no files. Other columns don't matter."""
    path = vocabulary or default_vocabulary()
    kept = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kept = kept.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        kind = f"<u{encoder(path).width}"
        shard = TaskContext.get().partitionId()
        rows, at, last, nth = [], 0, object(), 0

        def blobs():
            nonlocal at, last, nth
            for batch in batches:
                keys = batch.column(0).to_pylist()
                for a, b, ids, first, _, _ in encoded(batch.column(1), path):
                    own, order = [], np.diff(first) + 1
                    for k in keys[a:b]:
                        nth = nth + 1 if k == last else 0
                        last = k
                        own.append(nth)
                    ends = np.cumsum(order)
                    rows.append(pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64()), pa.array(own, pa.int64()), pa.array(np.full(b - a, shard, np.int32)), pa.array(at + ends - order), pa.array(order)], names=["doc_id", "nth", "shard", "offset", "length"]))
                    at += int(ends[-1]) if len(ends) else 0
                    yield np.insert(ids, first[1:], END_ID).astype(kind).tobytes()

        stream = blobs()
        head = next(stream, None)
        if head is not None:
            write_file(f"{folder}/shards/{shard:06d}.{kind[1:]}", (x for part in ([head], stream) for x in part))
        yield from rows

    where = saved(kept.mapInArrow(run, "doc_id long, nth long, shard int, offset long, length long"), "store-places")
    parts = max(1, -(-where.count() // INDEX_KEYS))
    keyed = where.withColumn("key", F.xxhash64("doc_id", "nth")).withColumn("part", F.pmod(F.shiftright("key", 7), F.lit(parts)).cast("int"))

    def index(batches):
        for part, t in _by_group(batches, []):
            key, shard, offset, length = (t.column(i).to_numpy() for i in range(1, 5))
            write_file(f"{folder}/index/{int(part):06d}.mph", [index_bytes(key.astype(np.int64).view(np.uint64), shard, offset, length)])
            yield pa.RecordBatch.from_arrays([pa.array([int(part)], pa.int32()), pa.array([len(key)], pa.int64())], names=["part", "n"])

    made = keyed.select("part", "key", "shard", "offset", "length").repartition("part").sortWithinPartitions("part", "key").mapInArrow(index, "part int, n long")
    saved(made, "store-index")
    return parts


def lookup(keys: DataFrame, folder: str, parts: int) -> DataFrame:
    """(doc_id, nth) to (doc_id, nth, shard, offset, length), from the index files; keys that aren't there give no row."""
    keyed = keys.withColumn("key", F.xxhash64("doc_id", "nth")).withColumn("part", F.pmod(F.shiftright("key", 7), F.lit(parts)).cast("int"))

    def run(batches):
        at, index = None, None
        for batch in batches:
            part = batch.column(0).to_numpy()
            for p in np.unique(part):
                if p != at:
                    f, path = _fs(f"{folder}/index/{int(p):06d}.mph")
                    with f.open_input_file(path) as x:
                        index = Index(x.read())
                    at = p
                take = np.flatnonzero(part == p)
                found, shard, offset, length = index.find(batch.column(1).to_numpy().take(take).view(np.uint64))
                rows = pa.array(take[found])
                yield pa.RecordBatch.from_arrays([batch.column(2).take(rows), batch.column(3).take(rows), pa.array(shard[found]), pa.array(offset[found]), pa.array(length[found])], names=["doc_id", "nth", "shard", "offset", "length"])

    return keyed.select("part", "key", "doc_id", "nth").repartition("part").sortWithinPartitions("part").mapInArrow(run, "doc_id long, nth long, shard int, offset long, length long")


def read_store(places: DataFrame, folder: str, wide: str = "u2") -> DataFrame:
    """(doc_id, nth, shard, offset, length) to (doc_id, nth, shard, offset, ids_crc32, n_tokens), from the shard files."""

    def run(batches):
        at, file = None, None
        for batch in batches:
            shard, offset, length = (batch.column(i).to_numpy() for i in (2, 3, 4))
            crc, n = [], []
            size = int(wide[1:])
            for s, o, k in zip(shard, offset, length, strict=True):
                if s != at:
                    if file is not None:
                        file.close()
                    f, path = _fs(f"{folder}/shards/{int(s):06d}.{wide}")
                    file, at = f.open_input_file(path), s
                file.seek(int(o) * size)
                ids = np.frombuffer(file.read(int(k) * size), f"<{wide}").astype("<u4")
                crc.append(zlib.crc32(ids.tobytes()))
                n.append(len(ids))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(crc, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "nth", "shard", "offset", "ids_crc32", "n_tokens"])
        if file is not None:
            file.close()

    return places.repartition("shard").sortWithinPartitions("shard", "offset").mapInArrow(run, "doc_id long, nth long, shard int, offset long, ids_crc32 long, n_tokens long")


def stored(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row of docs: written to a new store in the shared folder, then read back from
    its files, by index and shard."""
    folder = f"{shared_dir(docs.sparkSession)}/store-{uuid.uuid4().hex}"
    parts = write_store(docs, folder, text, doc_id, vocabulary)
    ids = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n"))
    keys = ids.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth"))
    read = saved(read_store(lookup(keys, folder, parts), folder, f"u{encoder(vocabulary or default_vocabulary()).width}"), "store-read")
    totals = read.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # a row per shard
    begin = totals.select(F.col("shard").alias("s"), F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    out = read.join(begin, F.col("shard") == F.col("s"))
    return out.select("doc_id", (F.col("begin") + F.col("offset")).cast("long").alias("start"), "n_tokens", "ids_crc32")
