"""The operators on hard rows, against brute force or the libraries."""

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from fleetlens.llm import (
    bpe, exact_dedup, fingerprint, hmm, html_text, language_id, packing, pieces, simhash, token_store)
from fleetlens.llm.common import documents, vocabulary_path
from fleetlens.session import scratch_path

from . import brute
from .conftest import ROWS


def same_rows(df, expected):
    assert Counter(tuple(r) for r in df.collect()) == Counter(expected)


def texts():
    return [(r[0], r[1] or "") for r in ROWS]


def tokens(name):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary_path(name))
    return lambda t: lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_dedup(docs, fan_in):
    got = exact_dedup.exact_dedup(docs, fan_in=fan_in).collect()
    classes = defaultdict(list)
    for i, t in texts():
        classes[brute.normalised_sha(t)].append(i)
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((i, h) for h, x in classes.items() for i in x)
    for r in got:
        ids = [i for i in classes[r.text_sha256] if i is not None]
        assert (r.keep_id, r.group_size) == (min(ids, default=None), len(classes[r.text_sha256]))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == set(classes)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_without_copies_keeps_columns_and_one_row_of_each(docs):
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    assert len(rows) == len({brute.normalised_sha(t) for _, t in texts()})
    assert {r.kept_key for r in rows} == {"clash"}


def test_simhash_groups(docs):
    same_rows(simhash.simhash_groups(docs), brute.simhash_groups(texts()))


def test_simhash_links_of_close_fingerprints(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(60):
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                c ^= 1 << int(b)
            fps.add(c)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    want = brute.components(fps, 2)
    for crowd in (8, 2048):  # with and without a second deal
        links = simhash.fingerprint_links(df, 2, crowd).collect()
        pairs = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in links]
        assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
        assert brute.joined(fps, pairs) == want


def test_simhash_crowd_of_one_half_is_dealt_in_small_groups(spark, monkeypatch):
    rng = np.random.default_rng(7)
    half = 0x12345678
    fps = {half | int(x) << 32 for x in rng.integers(0, 1 << 20, 3000)} | {half ^ 1 << 5 | int(x) << 32 for x in range(300)}
    fps = sorted(fps)
    seen = []
    compare = simhash.compare_groups

    def noted(rows, keys, *more):
        seen.append(rows.groupBy(*keys).count().agg({"count": "max"}).first()[0])
        return compare(rows, keys, *more)

    monkeypatch.setattr(simhash, "compare_groups", noted)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    links = simhash.fingerprint_links(df, 2, 64).collect()
    assert brute.joined(fps, [(r.a, r.b) for r in links]) == brute.components(fps, 2)
    assert seen[0] > 2000 and seen[-1] <= 500 and len(seen) > 2


def test_every_pair_within_the_threshold_shares_an_anchor():
    rng = np.random.default_rng(5)
    for word in rng.integers(0, 1 << 63, 3, dtype=np.uint64).tolist():
        for flips in itertools.chain([()], [(a,) for a in range(64)], itertools.combinations(range(64), 2)):
            other = word
            for b in flips:
                other ^= 1 << b
            pair = np.array([word, other], dtype=np.uint64)
            met = False
            for first, width in simhash.blocks_of(2):
                rows, anchors = simhash.anchors_of(pair, first, width)
                met = met or bool(set(anchors[rows == 0]) & set(anchors[rows == 1]))
            assert met, flips


def test_without_near_copies(docs):
    left = simhash.without_near_copies(docs)
    assert left.columns == docs.columns
    want = {i for i, _, c in brute.simhash_groups(texts()) if i is not None and i == c}
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_token_counts(docs):
    encode = tokens(bpe.VOCABULARY)
    same_rows(bpe.token_counts(docs), [(i, len(t.encode()), n := len(encode(t)), n > 1024) for i, t in texts()])


def test_token_store(docs, spark):
    encode, at, want = tokens(token_store.VOCABULARY), 0, []
    got = token_store.stored(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in texts())
    by_start = sorted(got, key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in by_start]
    assert keys == sorted(keys)
    for r in by_start:
        assert r.start == at
        at += r.n_tokens
    for i, t in texts():
        ids = np.array([*encode(t), 2], dtype="<u4")
        want.append((i, len(ids), zlib.crc32(ids)))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(want)
    folder = scratch_path(spark, "store")
    manifest = token_store.write_store(docs, folder).filter("last_id is not null").collect()
    found = [ids for m in manifest if (ids := token_store.Shard(f"{folder}/{m['name']}").get(10)) is not None]
    assert [x.tolist() for x in found] == [[*encode(dict(texts())[10]), 2]]
    assert all(token_store.Shard(f"{folder}/{m['name']}").get(987654) is None for m in manifest)


def test_lookup_over_the_whole_store(spark, docs):
    encode = tokens(token_store.VOCABULARY)
    more = [(i, f"text number {i}") for i in range(1000, 3000)] + [(1500, "again"), (1500, "and again")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).repartition(6)
    folder = scratch_path(spark, "lookup-store")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_store.write_store(df, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert manifest.count() > 1
    asked = [0, 3, 9, 10, 1000, 1500, 1500, 2999, 5000, -7, None]
    keys = spark.createDataFrame([(k, "x") for k in asked], "doc_id long, ids string")
    got = Counter((r.doc_id, tuple(r.ids)) for r in token_store.lookup(keys, manifest, folder).collect())
    want = Counter((i, (*encode(t), 2)) for i, t in [*texts(), *more] if i in set(asked) - {None})
    assert got == want
    nothing = token_store.write_store(df.limit(0), folder)
    assert token_store.lookup(keys, nothing, folder).collect() == []


def test_token_store_is_read_by_a_task_per_shard(spark):
    from pyspark.sql import functions as F

    folder = scratch_path(spark, "store")
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several small shards
    try:
        manifest = token_store.write_store(docs, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1
    got = token_store.read_store(manifest, folder).groupBy(F.spark_partition_id()).count().collect()
    assert len(got) == manifest.count() and sum(r["count"] for r in got) == 20000


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20000])
def test_perfect_hash_is_minimal(n):
    keys = token_store.hashed(np.arange(n, dtype=np.int64) * 7, np.zeros(n, np.int64))
    assert sorted(token_store.PerfectHash.build(keys).slots(keys)) == list(range(n))


def test_packing(docs):
    encode = tokens(packing.VOCABULARY)
    got = packing.packed(docs, group_size=4).collect()
    spans = Counter()
    for i, t in texts():
        ids = np.array([*encode(t), 0], dtype="<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        spans.update((i, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter(tuple(r)[:5] for r in got) == spans
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for x in sequences.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 2048


def test_lower_bound_and_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 11, rng.integers(1, 8))
        _, _, bins = packing.best_fit_decreasing(lengths, 10)
        assert packing.lower_bound(lengths, 10) <= brute.fewest_bins(lengths.tolist(), 10) <= bins
    assert packing.lower_bound(np.array([6, 6, 6, 4]), 10) == 3


def test_edited_fingerprints(docs):
    rows = sorted({(i is not None, i or 0, t) for i, t in texts()})
    got = defaultdict(list)
    for r in fingerprint.edited_fingerprints(docs).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(ROWS)
    known = [r for r in rows if r[0]]
    for this, after in zip(known, known[1:]):
        n, (r, *more) = len(this[2]), got[this[1]]
        edited = this[2][:n - n // 2] + after[2][:n // 2]
        assert all(tuple(m) == tuple(r) for m in more)
        assert (r.n_chars, r.edited_sha256) == (n, brute.sha(edited))
        near = brute.jaccard(brute.shingles(this[2]), brute.shingles(edited))
        few = max(len(brute.shingles(this[2])), len(brute.shingles(edited))) <= fingerprint.LADDER[0][0]
        assert r.near_edited == pytest.approx(near, abs=1e-12 if few else 0.25)


@pytest.mark.parametrize("n", [65, 256, 257, 1000, 2048, 2049, 6000, 20000])
def test_likeness_of_any_length_is_near_the_exact(spark, n):
    a = " ".join(f"w{i}" for i in range(n))
    pairs = [(a, " ".join(f"w{i}" if i < n * share else f"v{i}" for i in range(n))) for share in (0.25, 0.5, 0.9)]
    df = spark.createDataFrame([*pairs, (a, a), (a, a[:600])], "a string, b string")
    for c in "ab":
        df = fingerprint.with_sketch(df, c, f"s{c}")
    df = fingerprint.compared(df, "sa", "sb", "near", "inside")
    for r in df.collect():
        want = brute.jaccard(brute.shingles(r.a), brute.shingles(r.b))
        exact = max(len(brute.shingles(x)) for x in (r.a, r.b)) <= 256
        assert r.near == pytest.approx(want, abs=1e-12 if exact or r.a == r.b else 0.17)
        for s in (r.sa, r.sb):
            assert all(h <= s.limit for h in s.hashes) and s.limit in {fingerprint.TOP // k for k in (1, 4, 16)}


def test_sketches_merge(spark):
    a, b = " ".join(f"a{i}" for i in range(3000)), " ".join(f"b{i}" for i in range(70))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    for c in "ab":
        df = fingerprint.with_sketch(df, c, f"s{c}")
    whole = set(df.select(fingerprint.merged("sa", "sb").alias("m")).first().m.hashes)
    row = df.first()
    limit = min(row.sa.limit, row.sb.limit)
    assert whole == {h for h in [*row.sa.hashes, *row.sb.hashes] if h <= limit}
    assert all(h in row.sa.hashes for h in row.sa.hashes if h < fingerprint.TOP // fingerprint.SCALE)


def test_sentencepiece_is_the_library_and_returns(docs):
    model = pieces.model(vocabulary_path(pieces.VOCABULARY))
    encoded = pieces.encoded(docs)
    want = Counter((i, tuple(model.lib.encode(t))) for i, t in texts())
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    same_rows(pieces.decoded(encoded), texts())
    assert all(r.same for r in pieces.round_trip(docs).collect())
    for odd in ([], [0], [1, 2], [131, 200, 300], [28705, 28705], [229, 148, 163, 131, 500]):
        assert model.decode(odd) == model.lib.decode(odd)


def test_unigram_type_takes_the_best_sum():
    with open(vocabulary_path(pieces.VOCABULARY), "rb") as f:
        proto = f.read()
    model = pieces.Model(proto)
    model.type = pieces.UNIGRAM
    for word in ("▁the", "▁hested", "▁garden", "▁▁x", "abc"):
        best = brute.best_sum(word, {p: model.score[i] for p, i in model.ids.items()})
        assert sum(model.score[i] for i in model.best_path(word)) == pytest.approx(best)


def test_language_id(docs, spark):
    same = {r.doc_id: r for r in language_id.identified(docs).collect() if r.doc_id is not None}
    for i in (2, 4, 6):
        assert (same[i].lang_pred, same[i].score) == ("und", 0.0)
    assert same[7].lang_pred == "und"
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in same.items())
    real = documents(spark, SF_SMALL)
    got = language_id.identified(real).filter("held_out").join(real, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert {r.doc_id for r in language_id.with_language(docs).collect()}.isdisjoint({2, 4, 6, 7})


def test_segmentations_are_summed():
    table = {"▁": (0.1,), "▁a": (0.2,), "a": (0.3,), "ab": (0.15,), "b": (0.25,), "<0xC3>": (0.01,), "<0xA9>": (0.02,)}
    s = language_id.Segmenter(table, 1)
    scorer = language_id.Scorer(language_id.LanguageModel(["x"], [0.0], table))
    for word in ("a", "ab", "abab", "é", "aéb", "ab" * 90):
        want = brute.log_sum_of_segmentations("▁" + word, table, s)
        assert s.log_likelihoods(word)[0] == pytest.approx(want)
        assert scorer._new([word, "b"])[0][0] == pytest.approx(want)


def test_new_words_are_scored_a_bounded_number_at_once(monkeypatch):
    table = {"▁": (0.1, 0.2), "a": (0.3, 0.1), "ab": (0.15, 0.2), "b": (0.25, 0.3)}
    scorer = language_id.Scorer(language_id.LanguageModel(["x", "y"], [0.0, 0.0], table))
    words = ["a" * i + "b" * j for i in range(6) for j in range(6)][1:]
    sizes, forward = [], scorer._forward
    monkeypatch.setattr(language_id, "AT_ONCE", 8)
    monkeypatch.setattr(scorer, "_forward", lambda some: sizes.append(len(some)) or forward(some))
    for word, got in zip(words, scorer._new(words), strict=True):
        assert list(got) == pytest.approx(scorer.segments.log_likelihoods(word))
    assert sum(sizes) == len(words) and max(sizes) == 8
    assert scorer._values(["a½b"])[0].tolist() == pytest.approx(
        [x + y for x, y in zip(scorer._new(["a"])[0], scorer._new(["b"])[0], strict=True)] + [2])


def test_long_words_are_learnt_from():
    low = 1 / 32000
    bytes_of = {f"<0x{b:02X}>": (low,) for b in range(256)}
    s = language_id.Segmenter({"▁": (low,), "a": (low,), "b": (low,), "ab": (low,), **bytes_of}, 1)
    for word in ("日本語文" * 20, "ab" * 400, "日ab本" * 300):
        uses = Counter()
        for piece, x in s.expected(word):
            uses[piece] += x
        covered = sum(x * (1 / 3 if p.startswith("<0x") else len(p)) for p, x in uses.items())
        assert uses["▁"] == pytest.approx(1) and covered == pytest.approx(len(word) + 1)
    short, long = (Counter() for _ in range(2))
    for found, n in ((short, 4), (long, 400)):
        for piece, x in s.expected("abé" * n):
            found[piece] += x / n
    assert all(long[p] == pytest.approx(short[p]) for p in ("a", "b", "ab", "<0xC3>"))


def test_hmm_learns_more_than_word_counts_and_ends(spark):
    df = documents(spark, SF_SMALL)
    rows = hmm.scored(df).filter("held_out").collect()
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 0.2


def test_hmm_of_few_words_and_of_long_ones(spark):
    long = "w" * 300
    rows = [(i, f"{long} a b {long} c{i % 3}") for i in range(40)] + [(99, None)]
    got = hmm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 41 and all(r.score < 0 for r in got)
    want = brute.unigram_rows([(i, t or "") for i, t in rows])
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == Counter(
        (i, n, k, b) for i, _, n, k, _, b in want)


def test_hmm_slices_of_any_size_give_the_same_scores(docs, monkeypatch):
    whole = {(r.doc_id, r.n_tokens): r.score for r in hmm.scored(docs).collect()}
    monkeypatch.setattr(hmm, "CHARS", 500)
    for r in hmm.scored(docs).collect():
        assert r.score == pytest.approx(whole[r.doc_id, r.n_tokens], rel=1e-6)


def test_hmm_keeps_and_shuffles_slices_compressed(spark):
    """A slice's columns, as a shuffle moves them, need under two bytes a token."""
    r = np.random.default_rng(0)
    texts = [" ".join(f"w{x}" for x in r.zipf(1.3, 400) % 50_000) for _ in range(200)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = hmm.Corpus(docs, "doc_id", "text", 7, 2).slices.collect()
    parts = [hmm.Slice({c: pa.scalar(bytes(row[c])) for c in hmm.NUMBERS}) for row in rows]
    found = {i: [p.vocabulary[x] for x in tokens] for row, p in zip(rows, parts, strict=True)
             for i, tokens in zip(row.doc_ids, hmm.cut_up(p.tokens, p.lengths), strict=True)}
    assert found == {i: [*hmm.words_of(t), hmm.END] for i, t in enumerate(texts)}
    assert sum(len(row.tokens) for row in rows) < 2 * sum(len(p.tokens) for p in parts)


def test_hmm_trains_on_classes_that_are_found_once(docs):
    corpus = hmm.Corpus(docs, "doc_id", "text", 7, 2)
    got = [(hmm.Training(pa.scalar(bytes(r.classes)), pa.scalar(bytes(r.lengths)), corpus.kind)) for r in corpus.training.collect()]
    got = Counter(tuple(x.tolist()) for part in got for x in hmm.cut_up(part.classes, part.lengths))
    rows = docs.select("doc_id", "text").collect()
    want = Counter(tuple(corpus.classes.of([*hmm.words_of(t or ""), hmm.END]).tolist()) for i, t in rows
                   if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 or i is None)
    assert got == want


def test_hmm_scores(docs):
    got = hmm.scored(docs).collect()
    want = brute.unigram_rows(texts())
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in got) == Counter(want)
    assert all(r.score < 0 for r in got)


def test_forward_recursion_sums_all_paths():
    rng = np.random.default_rng(2)
    start, move, emit = rng.random(3), rng.random((3, 3)), rng.random((5, 3))
    chain = hmm.Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    sequences = [rng.integers(0, 5, n).astype(np.int32) for n in (1, 4, 2, 6, 6)]
    want = [np.log10(brute.hmm_probability(chain, s)) for s in sequences]
    assert chain.log10_likelihoods(sequences) == pytest.approx(want)
    # One round of expected counts never lowers the likelihood.
    s, m, e = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    chain.expected(sequences, s, m, e)
    assert s.sum() == pytest.approx(5) and m.sum() == pytest.approx(14) and e.sum() == pytest.approx(19)
    better = hmm.Chain(s / s.sum(), m / m.sum(axis=1, keepdims=True), e / e.sum(axis=0))
    assert better.log10_likelihoods(sequences).sum() > chain.log10_likelihoods(sequences).sum()


def test_one_document_id_with_two_texts(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, EN_TEXT), (1, long), (1, long), (2, long + " end"), (3, EN_TEXT), (None, EN_TEXT)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string").repartition(3)
    near = [(r.doc_id, r.text) for r in simhash.without_near_copies(df).collect()]
    roots = {t: c for (_, t), (_, _, c) in zip(rows, brute.simhash_groups(rows))}
    assert Counter(near)[1, EN_TEXT] == Counter(near)[1, long] == 1 and (3, EN_TEXT) not in near
    assert ((2, long + " end") in near) == (roots[long + " end"] == 2)
    exact = [(r.doc_id, r.text) for r in exact_dedup.without_copies(df).collect()]
    assert Counter(exact) == Counter([(1, EN_TEXT), (1, long), (2, long + " end")])


EN_TEXT = "the cat sat on the mat and the dog ran after the cat in the garden " * 3


PAGE = ("<!DOCTYPE html><html><head><title>t</title><script>var x='</p><p>no';</script></head><body>"
        "<header>Site</header><nav><ul><li><a href='/a'>A{0}</a><li>B</ul></nav><div class='ad'>Buy {0}</div>"
        "<article><h1>Title {0}</h1><p>One &amp; two<br>three{0}<p>Four <b>five</b>  six &eacute;<!-- no --></p>"
        "<div>Same on every page</div><div class=\"comments\">Nice {0}</div></article>"
        "<aside>Side</aside><footer>&copy;</footer></body></html>")


def test_html_text(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i)) for i in range(6)]
    rows += [(6, None, None), (7, "nonsense", ""), (8, "http://h.example/8", "no markup at all"), (9, "http://x.y/", "<p>"),
             (None, "http://z.example/", "<main>kept <p>too"), (0, "http://h.example/0", PAGE.format(0))]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, token int")
    got = html_text.extracted(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id is not None and r.page_id < 6:
            k = r.page_id
            assert r.text.startswith(f"Title {k}\nOne & two three{k}\nFour five six é")
            assert "Nice" not in r.text and "Buy" not in r.text and "Side" not in r.text
    assert {r.page_id: r.text for r in got if r.page_id in (6, 7, 8, 9)} == {6: "", 7: "", 8: "no markup at all", 9: ""}
    assert [r.text for r in got if r.page_id is None] == ["kept\ntoo"]


@pytest.mark.parametrize("tag", [
    "body class='has-sidebar'", "article class='comments-open'", "div class='with-sidebar'", "div style='overflow:hidden'",
    "div aria-hidden='false'", "div data-title='a hidden gem'", "div class='social-sciences'", "main class='comments'",
    "div class='widget'", "form id='all'", "body class='menu'"])
def test_html_attributes_do_not_hide_the_article(tag):
    blocks, _ = html_text.parse(f"<{tag}><p>First one<p>Second two</{tag.split()[0]}><p hidden>No</p><nav>No</nav>")
    assert html_text.main_text(blocks, {}) == "First one\nSecond two"


@pytest.mark.parametrize("body", ["<article><h1>T</h1><p>Long story<p>Its end</article>", "<h1>T</h1><p>Long story<p>Its end"])
def test_html_copies_of_a_page_keep_their_text(spark, body):
    rows = [(i, f"http://h{n}.example/{i}", body) for n in (4, 5, 50, 5000) for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = html_text.extracted(pages).groupBy("host", "text").count().collect()
    assert sorted((r["count"], r.text) for r in got) == [(n, "T\nLong story\nIts end") for n in (4, 5, 50, 5000)]


def test_html_paragraph_of_all_pages_stays_in_the_article(spark):
    rows = [(i, f"http://h.example/{i}", f"<div>Log in<article><h1>T{i}</h1><p>Same here<p>Own {i}</article>") for i in range(9)]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"T{i}\nSame here\nOwn {i}" for i in range(9)}


NOTICE = "<div class='legal'>All rights</div><div class='list'><p><a href='/'>Home</a><p><a href='/x'>News {0}</a></div>"
LAYOUTS = {
    "title.example": ("<div class='post'><h1>T{0}</h1><div class='body'><p>One {0}<p>Two {0} and more of it</div></div>",
                      "T{0}\nOne {0}\nTwo {0} and more of it"),
    "parts.example": ("<div class='intro'>Intro {0}</div><div class='body'><p>Main {0}</div><div class='body'><p>More {0}</div>"
                      "<div class='end'>End {0}</div>", "Intro {0}\nMain {0}\nMore {0}\nEnd {0}"),
    "table.example": ("<h2><a href='/{0}'>T{0}</a></h2><p>Before {0}<table><tr><td>A long cell of page {0}<td>And one more, {0}"
                      "</table><p>After {0}", "T{0}\nBefore {0}\nA long cell of page {0}\nAnd one more, {0}\nAfter {0}"),
    "outside.example": ("<h1>T{0}</h1><article><p>One {0}</article>", "T{0}\nOne {0}"),
    "marked.example": ("<h1>T{0}</h1><div class='widget'><p>A long text of the page {0}, all of it</div>",
                       "T{0}\nA long text of the page {0}, all of it")}


def test_html_all_slots_that_vary_are_kept(spark):
    rows, want = [], {}
    for host, (body, text) in LAYOUTS.items():
        for i in range(12):
            url = f"http://{host}/{i}"
            rows.append((i, url, f"<body>{body.format(i)}{NOTICE.format(i)}</body>"))
            want[url] = text.format(i)
    two = [LAYOUTS["title.example"], LAYOUTS["parts.example"], LAYOUTS["table.example"]]
    for i in range(30):  # layouts of different shares
        body, text = two[0 if i < 18 else 1 if i < 26 else 2]
        url = f"http://mixed.example/{i}"
        rows.append((i, url, f"<body>{body.format(i)}</body>"))
        want[url] = text.format(i)
    for i in range(8):  # near copies
        url = f"http://near.example/{i}"
        rows.append((i, url, f"<h1>Title</h1><p>A long story, the same on all pages<div class='when'>At {i}</div>"))
        want[url] = f"Title\nA long story, the same on all pages\nAt {i}"
    got = html_text.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.url: r.text for r in got} == want


CLASSES = ["comment-list", "comments-area", "post-comments", "cookie-banner", "ad-slot", "ad_container", "share-buttons",
           "related-posts-3"]


@pytest.mark.parametrize("word", CLASSES)
def test_html_regions_named_by_parts_of_words(word):
    page = f"<article><h1>T</h1><p>Prose<div class='x {word}'><p>Not this</div><p>More</article><div id='{word}'>Nor this</div>"
    assert html_text.main_text(html_text.parse(page)[0], {}) == "T\nProse\nMore"


@pytest.mark.parametrize("page, text", [
    ("<article><p title=it's>One<p>Two<p title=don't>Three</article>", "One\nTwo\nThree"),
    ("<article><p data-x='a>b' data-y=\"c>d\">One<p a = 'e>f'>Two</article>", "One\nTwo"),
    ("<article><p>One<p style='display:none'>No<p style=\"color:red; Display : None !important\">No"
     "<p style='visibility:hidden'>No<p style='display:nonesuch'>Two</article>", "One\nTwo"),
    ("<article><p>One<math><mi>x</mi></math><section class='social'><p>Society</section></article>", "One\nSociety")])
def test_html_odd_attributes(page, text):
    assert html_text.main_text(html_text.parse(page)[0], {}) == text


@pytest.mark.parametrize("page", ["<b>x" * 20_000, "<div>x" * 20_000, "<p><i>" + "<b>x</b>" * 20_000, "<ul>" + "<li><a>x" * 20_000])
def test_html_very_deep_and_long_pages_take_linear_time(page):
    import time

    begun = time.time()
    blocks, paths = html_text.parse(page)
    assert sum(b.text.count("x") for b in blocks) == 20_000
    assert max(map(len, paths), default=0) <= 5 * html_text.DEPTH and time.time() - begun < 5


def test_html_numbered_classes_are_one_path(spark):
    body = "<body class='page-{0}'><div class='post post-{0}'><h1>T{0}</h1><p>Own text of page {0} alone</div><div class='end'>Filed under all</div>"
    rows = [(i, f"http://h.example/{i}", body.format(i)) for i in range(8)]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"T{i}\nOwn text of page {i} alone" for i in range(8)}


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6])
def test_html_notices_go_on_hosts_of_any_size(spark, n):
    rows = [(i, f"http://h.example/{i}", f"<div class='b'><h1>T{i}</h1><p>Own text of page {i}</div><p>All rights") for i in range(n)]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"T{i}\nOwn text of page {i}" for i in range(n)}


def test_numerals_that_are_no_letters_have_no_language(spark):
    docs = spark.createDataFrame([(1, "good morning", "en"), (2, "bonjour monde", "fr"), (3, "½ ² ① 7", "en"),
                                  (4, "x²good½morning①", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identified(docs).collect()}
    assert got[3] == ("und", 0.0) and got[4][0] != "und"
    assert language_id.words_of("x²Good½ ① Ⅷ ab1c") == ["x", "good", "ab", "c"]


def test_empty_tables(no_docs, spark):
    for df in (exact_dedup.exact_dedup(no_docs), exact_dedup.without_copies(no_docs), simhash.simhash_groups(no_docs),
               bpe.token_counts(no_docs), token_store.stored(no_docs), packing.packed(no_docs), hmm.scored(no_docs),
               fingerprint.edited_fingerprints(no_docs), language_id.identified(no_docs), pieces.round_trip(no_docs),
               html_text.extracted(spark.createDataFrame([], "page_id bigint, url string, html string"))):
        assert df.count() == 0


def test_language_sample_counts_a_repeated_document_once(spark):
    from fleetlens.llm import language_id

    rows = [(1, "good morning", "en")] * 400 + [(2, "bonjour monde", "fr"), (3, "hello there", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    once = language_id.train(docs.dropDuplicates(), sample=300)
    model = language_id.train(docs, sample=500)
    assert model.languages == once.languages == ["en", "fr"]
    assert model.table["▁good"] == pytest.approx(once.table["▁good"])
    assert len(language_id.predict(docs, model).collect()) == len(rows)
