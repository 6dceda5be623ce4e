"""The corpus pipeline, stage by stage and whole, against brute force."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from fleetlens.llm.common import vocabulary_path
from fleetlens.session import scratch_path

from . import brute
from .conftest import DE, EN

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, dedup_key string"


def table_rows():
    long = " ".join(f"{EN} {i}" for i in range(300))
    texts = [(1, EN + " one"), (2, EN + " one"), (3, EN.replace(" ", "\n") + " one"), (4, DE), (5, None), (6, ""),
             (7, "123 ½ !!"), (8, long), (9, long + " tail"), (10, DE + " zwei drei vier"), (11, long), (12, EN + " other words here"),
             (12, DE + " noch ein satz unter derselben nummer"), (13, " \t")]
    texts += [(20 + i, f"{EN} {DE} number {i} " * (1 + 7 * i)) for i in range(25)]
    return [(i, t, "de" if t and t.startswith("der") else "en", "s", len(t or ""), "clash") for i, t in texts]


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "pipeline-input")
    spark.createDataFrame(table_rows(), SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def kept_by_language(rows):
    return [(i, t) for i, t, *_ in rows if re.search("[a-z]", t or "")]


def kept_exact(rows):
    classes = defaultdict(list)
    for i, t in rows:
        classes[brute.normalised_sha(t)].append((i, t))
    return [min(c, key=lambda x: x[0]) for c in classes.values()]


def kept_near(rows):
    # Two texts of one doc_id may be in two groups.
    root, roots = brute.components([brute.simhash(t) for _, t in rows], 2), defaultdict(list)
    for i, t in rows:
        roots[root[brute.simhash(t)]].append((i, t))
    return [min(c, key=lambda x: x[0]) for c in roots.values()]


def test_stages_one_after_the_other(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = kept_by_language(table_rows())
    for (name, stage), kept in zip(corpus_pipeline.STAGES[:3], (lambda x: x, kept_exact, kept_near)):
        docs = stage(spark, docs, folder)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
        got, want = texts_of(docs), kept(want)
        # Of equal texts with white space of their own, any row of the smallest id.
        assert Counter((i, brute.normalised_sha(t)) for i, t in got) == Counter((i, brute.normalised_sha(t)) for i, t in want), name
    assert 5 < len(want) < len(table_rows())


def test_the_whole_pipeline(spark, folder):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    rows = corpus_pipeline.run(spark, folder).collect()
    kept = kept_near(kept_exact(kept_by_language(table_rows())))
    size = Counter()
    for i, t in kept:
        size[i] += len(lib.encode(t, add_special_tokens=False).ids) + 1
    found = Counter()
    for r in rows:
        found[r.doc_id] += r.length
    assert found == size
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    assert -(-sum(size.values()) // 2048) <= len(sequences) <= -(-sum(size.values()) // 2048) + 2


def test_empty_and_rejected_tables(spark):
    for rows in ([], [(1, None, None, None, None, None), (2, "12", "en", "s", 2, "")]):
        path = scratch_path(spark, "pipeline-empty")
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
        assert corpus_pipeline.run(spark, path).collect() == []
