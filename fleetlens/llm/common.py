"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fleetlens
from fleetlens.session import checkpoint_root, scratch_path

# Task functions travel by value: no executor needs the package installed.
cloudpickle.register_pickle_by_value(fleetlens)

#: The ASCII white space of the contracts, as a Java and RE2 class.
SPACE = "[ \\t-\\r]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Writer's options of tables whose rows are large: the writer must not wait for
#: many rows, and a reader holds a row group's columns at once. Zstandard makes
#: packed numbers and vocabularies a quarter smaller than the usual codec.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1",
              "parquet.block.size": str(4 << 20), "compression": "zstd"}


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the doc_id as text, modulo ``by``; 0 without doc_id."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by


def text_of(column: str) -> Column:
    """A text column as string, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back;
    ``options`` are the writer's.

    Cuts lineage: what follows starts from the table, whichever executors
    are lost. The folder is removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**(options or {})).parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a small iterative state (labels, links)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(columns: Iterable[str], base: str) -> str:
    """``base``, with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def per_process(name: str, build: Callable[[], object], version: str = "") -> object:
    """An object kept in the Python worker across its tasks, until another
    ``version`` or another name is asked for: a worker that goes on to the next
    stage holds one operator's caches, not all.

    Task functions are pickled by value, so their module's globals are new in
    every task; automata, vocabularies and caches live here instead.
    """
    store = sys.modules.setdefault("_llm_worker_state", ModuleType("_llm_worker_state")).__dict__
    if store.get(name, (None,))[0] != version:
        for old in [k for k in store if not k.startswith("__")]:
            del store[old]
        built = build()
        store[name] = (version, built)
    return store[name][1]


class RecentCache:
    """A bounded cache in two generations: when the young one is full it
    becomes the old one, and what is used again moves back. Holds ``2 * size``
    entries and those of one call at most; eviction costs time, never results."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def ready(self, keys: set, compute: Callable[[list], Iterable]) -> dict:
        """A dictionary that has all ``keys``; ``compute`` gets the missing
        keys as a list and gives their values in order."""
        lacking = keys.difference(self.young)
        if len(self.young) + len(lacking) > self.size:
            self.old, self.young, lacking = self.young, {}, set(keys)
        again = {k for k in lacking if k in self.old}
        self.young.update((k, self.old[k]) for k in again)
        if asked := list(lacking - again):
            self.young.update(zip(asked, compute(asked), strict=True))
        return self.young


def texts_of(column: pa.Array) -> Iterator[str]:
    """A column's texts one after the other, null as empty: a batch of long
    texts is not held twice."""
    return (t.as_py() or "" for t in column)


def slices(texts: Iterable[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    """``texts`` in order, in lists of about ``chars`` characters (a longer
    text makes a list of its own), to bound what a step holds."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > chars:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def listed(values: pa.Array) -> list:
    """A string or binary array without nulls as a list; the way over NumPy makes
    no scalar for each value."""
    return values.to_numpy(zero_copy_only=False).tolist()


def shrunk(data: bytes) -> bytes:
    """``data`` compressed, behind its length: for rows that a table keeps and a
    shuffle moves."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def grown(data: pa.Buffer) -> pa.Buffer:
    """What ``shrunk`` was given."""
    return pa.decompress(data.slice(8), int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), codec="zstd")


def tokenizer(path: str):
    """The tokenizers library's object for a .json file, one per worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    def load():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return per_process(f"tokenizer {path}", load)


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer file lies (see /opt/tokenizers/README.md)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def batch(names: list[str], columns: list, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=names)
