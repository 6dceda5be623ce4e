"""Token ids in binary shards, with a minimal perfect hash index over documents.

A shard is two files. ``.ids`` holds the raw ids of its documents one after the
other, little-endian, 16 bits each if the vocabulary allows, else 32. ``.idx``
holds a minimal perfect hash of the documents' keys and, in its order, a 32-bit
fingerprint of the key, the first id and the number of ids; then the keys in
file order. A lookup hashes the key to its slot, compares the fingerprint and
reads the slice: constant time, whatever the shard's size.

The hash function is a cascade of bit arrays: a key whose place in the first
array no other key shares sets that bit, the others go on to the next, smaller
array. A key's slot is the number of set bits before its own, from a stored
directory of counts per 64 bits.

Shards are ranges of doc_id in ascending order, one per task, written to the
shared folder under names unique to the task attempt. A manifest, itself a
committed table with a row per shard, names those that count, so retried tasks
and lost executors leave at most unused files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import text_of, vocabulary_path, written
from fleetlens.llm.encoding import Words, encoder, tokenizer
from fleetlens.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END = 2
MAGIC = b"TIDX"
HEADER = "<4sIQQII"  # magic, id bytes, documents, ids, rows without key, levels
#: Bits of a level's array for each key that is left.
GAMMA = 2.0
#: Bytes of ids read at once.
WINDOW = 8 << 20


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix (the finaliser of SplitMix64) of each number."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashed(doc_ids: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Keys: a doc_id and the number of earlier rows of the shard with it."""
    return mixed(doc_ids.view(np.uint64) ^ mixed(repeats.astype(np.uint64), 101), 0)


class PerfectHash:
    """Levels of bits, and for each 64 of them the set bits before."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        words = np.concatenate(levels) if levels else np.empty(0, np.uint64)
        counts = np.bitwise_count(words).astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct 64-bit keys."""
        levels = []
        while len(keys):
            size = max(1, -(-int(GAMMA * len(keys)) // 64)) * 64
            place = mixed(keys, len(levels) + 1) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            levels.append(bits)
            keys = keys[~alone[place.astype(np.int64)]]
            if len(levels) > 200:
                raise ValueError("two documents have the same key hash")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 for a key that no level has. A key that was not
        built in may get another's slot."""
        found = np.full(len(keys), -1, dtype=np.int64)
        left, first = np.arange(len(keys)), 0
        for i, bits in enumerate(self.levels):
            if not len(left):
                break
            place = mixed(keys[left], i + 1) % np.uint64(64 * len(bits))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            here = (bits[word] >> bit) & np.uint64(1) == 1
            low = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[first + word] + np.bitwise_count(low)
            found[left[here]] = rank[here]
            left, first = left[~here], first + len(bits)
        return found


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1000) >> np.uint64(32)).astype("<u4")


def repeats_of(ids: np.ndarray) -> np.ndarray:
    """For each of ascending ids, how many equal ones stand before it."""
    if not len(ids):
        return np.empty(0, np.int64)
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    at = np.arange(len(ids))
    return at - np.maximum.accumulate(np.where(first, at, 0))


def index_bytes(doc_ids: np.ndarray, n_null: int, lengths: np.ndarray, item: int) -> bytes:
    """The .idx file of documents in file order, the first ``n_null`` without doc_id."""
    repeats = repeats_of(doc_ids[n_null:])
    # Rows without doc_id: numbered from 2**32 on.
    repeats = np.concatenate([np.arange(n_null) + (1 << 32), repeats])
    keys = hashed(doc_ids, repeats)
    perfect = PerfectHash.build(keys)
    slot = perfect.slots(keys)
    starts = np.cumsum(lengths) - lengths
    table = [np.empty(len(keys), t) for t in ("<u4", "<u8", "<u8")]
    for column, values in zip(table, (fingerprint(keys), starts, lengths), strict=True):
        column[slot] = values
    return b"".join([
        struct.pack(HEADER, MAGIC, item, len(keys), int(lengths.sum()), n_null, len(perfect.levels)),
        np.array([len(x) for x in perfect.levels], dtype="<u8").tobytes(),
        *[x.tobytes() for x in perfect.levels], *[x.tobytes() for x in table], doc_ids.astype("<i8").tobytes()])


class Shard:
    """A shard opened for keyed access; ``base`` is its path without suffix."""

    def __init__(self, base: str):
        fs, path = _files(base)
        data = memoryview(fs.open_input_stream(path + ".idx").read())
        magic, item, n, self.n_ids, self.n_null, n_levels = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError(f"{base}.idx is no index")
        at = struct.calcsize(HEADER)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += x.nbytes
            return x

        sizes = take("<u8", n_levels)
        self.perfect = PerfectHash([take("<u8", int(s)) for s in sizes])
        self.fingerprints, self.starts, self.lengths = take("<u4", n), take("<u8", n), take("<u8", n)
        self.doc_ids = take("<i8", n)
        self.item = item
        self.payload = fs.open_input_file(path + ".ids")

    def all_repeats(self) -> np.ndarray:
        return np.concatenate([np.arange(self.n_null) + (1 << 32), repeats_of(self.doc_ids[self.n_null:])])

    def find(self, doc_ids: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 where the shard has no such document."""
        keys = hashed(doc_ids, repeats)
        slot = self.perfect.slots(keys)
        slot[(slot < 0) | (self.fingerprints[slot] != fingerprint(keys))] = -1
        return slot

    def ids(self, slot: int) -> np.ndarray:
        """One document's ids, as unsigned 32-bit."""
        start, n = int(self.starts[slot]), int(self.lengths[slot])
        data = self.payload.read_at(n * self.item, start * self.item)
        return np.frombuffer(data, dtype=f"<u{self.item}").astype("<u4")

    def get(self, doc_id: int, repeat: int = 0) -> np.ndarray | None:
        """The ids of a document, None if it is not in this shard."""
        slot = self.find(np.array([doc_id], dtype=np.int64), np.array([repeat]))[0]
        return None if slot < 0 else self.ids(slot)


#: Hadoop's names of stores that pyarrow knows by another.
OTHER_NAMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def _files(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow.fs import FileSystem

    scheme, _, rest = path.partition("://")
    return FileSystem.from_uri(f"{OTHER_NAMES.get(scheme, scheme)}://{rest}" if rest else path)


def write_store(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                vocabulary: str | None = None, end: int = END) -> DataFrame:
    """Writes the shards into ``folder``; returns the manifest (shard, name,
    n_docs, n_ids, first_id, last_id), ascending in shard.

    Rows without doc_id come first; equal doc_ids are ordered by a hash of
    their text (which also deals them over several shards if they are many).
    """
    path = vocabulary or vocabulary_path(VOCABULARY)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(Words, path)
        item = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 and end < 1 << 16 else 4
        tail = np.array([end], dtype="<u4").tobytes()
        name = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, doc_ids, lengths, n_null = None, [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs, base = _files(f"{folder}/{name}")
                fs.create_dir(base.rsplit("/", 1)[0])
                out = fs.open_output_stream(base + ".ids")
            n_null += b.column(0).null_count
            doc_ids.append(b.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            for data in encode.encode(b.column(1).to_pylist()):
                ids = data + tail
                lengths.append(len(ids) // 4)
                out.write(np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes() if item == 2 else ids)
        if out is None:
            return
        out.close()
        ids, sizes = np.concatenate(doc_ids), np.array(lengths, dtype=np.int64)
        with fs.open_output_stream(base + ".idx") as f:
            f.write(index_bytes(ids, n_null, sizes, item))
        keyed = ids[n_null:].tolist()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([TaskContext.get().partitionId()], pa.int64()), "name": [name],
            "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([int(sizes.sum())], pa.int64()),
            "first_id": pa.array([keyed[0] if keyed else None], pa.int64()),
            "last_id": pa.array([keyed[-1] if keyed else None], pa.int64())})

    return written(ordered.mapInArrow(
        run, "shard bigint, name string, n_docs bigint, n_ids bigint, first_id bigint, last_id bigint"), "manifest")


def read_store(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document, by a keyed lookup in its shard: doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32."""
    # A row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("shard", "name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            shard = Shard(f"{folder}/{row['name']}")
            slot = shard.find(shard.doc_ids, shard.all_repeats())
            if (slot < 0).any():
                raise ValueError(f"{row['name']}: a key is not in its index")
            null = np.arange(len(slot)) < shard.n_null
            starts, sizes = shard.starts[slot].astype(np.int64), shard.lengths[slot].astype(np.int64)
            crcs = np.empty(len(slot), dtype=np.int64)
            window, first, last = b"", 0, 0  # bytes of ids read, and their range
            for i, (start, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                a, z = start * shard.item, (start + n) * shard.item
                if a < first or z > last:
                    first, size = a, max(z - a, WINDOW)
                    window = shard.payload.read_at(min(size, shard.n_ids * shard.item - a), a)
                    last = a + len(window)
                ids = np.frombuffer(window, dtype=f"<u{shard.item}", count=n, offset=a - first)
                crcs[i] = zlib.crc32(ids.astype("<u4"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.doc_ids, mask=null), pa.array(starts + row["before"]), pa.array(sizes),
                 pa.array(crcs)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # A task per shard: adaptive execution merges no partitions of a given number.
    return (shards.repartitionByRange(max(1, manifest.count()), "shard").select("name", "before")
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def lookup(keys: DataFrame, manifest: DataFrame, folder: str, doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ids (array<bigint>) of every stored document that has one of
    the ``keys``: several rows where a doc_id repeats in the store, none for a key
    that it has not; null keys find nothing, repeated ones count once.

    Shards hold ascending ranges of doc_id, so the manifest, a row per shard, tells
    each key's shards; a task opens a shard once, and its perfect hash gives the
    places of all keys dealt to it.
    """
    shards = [r for r in manifest.filter("first_id is not null").orderBy("shard").collect()]
    first = np.array([r["first_id"] for r in shards], np.int64)
    last = np.array([r["last_id"] for r in shards], np.int64)
    names = [r["name"] for r in shards]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            low, high = np.searchsorted(last, ids, "left"), np.searchsorted(first, ids, "right")
            n = np.maximum(high - low, 0)
            shard = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(np.repeat(ids, n))], names=["shard", "doc_id"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for b in batches:
            out_ids, out = [], []
            for k, doc in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != number:
                    number, shard = k, Shard(f"{folder}/{names[k]}")
                repeat = 0
                while (ids := shard.get(doc, repeat)) is not None:
                    out_ids.append(doc)
                    out.append(ids.astype(np.int64))
                    repeat += 1
            yield pa.RecordBatch.from_arrays([pa.array(out_ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                             names=["doc_id", "ids"])

    asked = keys.select(F.col(doc_id).cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    return (asked.mapInArrow(placed, "shard bigint, doc_id bigint").repartitionByRange(max(1, len(shards)), "shard")
            .sortWithinPartitions("shard").mapInArrow(found, "doc_id bigint, ids array<bigint>"))


def stored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           end: int = END) -> DataFrame:
    """Writes ``docs`` as a token store in the shared folder and reads it back.

    A null text is an empty one: only the end id. Repeated rows are separate
    documents; an empty table gives an empty store; other columns are not read.
    """
    folder = scratch_path(docs.sparkSession, "llm-token-store")
    return read_store(write_store(docs, folder, doc_id, text, vocabulary, end), folder)
