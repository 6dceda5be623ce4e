"""A hidden Markov language model, trained by Baum-Welch over all partitions.

Latent states follow a Markov chain; each state emits word classes. Every word
that makes up a stated share of all training tokens (``OWN_SHARE``) is a class of
its own, all others share classes by their ending, as many as there are own ones;
so the states' tables follow the counts and are bounded by the share. A word of a
shared class has its own probability within the class, from the corpus counts; a
word never seen takes the place kept for unseen ones. The probability of a text is
the sum over all state paths, computed exactly by the scaled forward recursion,
times the words' probabilities within their classes, its end included.

Texts are cut into words once, in slices of bounded size that hold a vocabulary
and the words' numbers, compressed; every later pass reads those. Corpus counts are made of
all training texts. Their number of distinct words has no bound, so no task or
driver holds them: each slice asks for the counts of its own words and meets them
again by its number.

The first guess of the states comes from all training texts too: how often the
most frequent words stand in a text together is a table of fixed size, whose rows
fall into groups of words that go together, and every text counts towards the
states by the groups its words are of. Then Baum-Welch runs over whole texts until
a round gains less than ``TOLERANCE`` a token: each task sums the expected counts
of its documents, and Spark adds the tables up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from fleetlens.llm.common import LARGE_ROWS, grown, listed, remainder, shrunk, slices, text_of, texts_of, written

STATES = 8
#: A word has a class of its own from this share of all training tokens on:
#: there are at most 1 / OWN_SHARE of them.
OWN_SHARE = 1 / 20_000
#: Shared classes, at least; else as many as own ones.
LEAST_SHARED = 1024
#: Longer words are known to the list of classes by their digest.
KEY_BYTES = 64
#: Frequent words whose company makes the first guess.
ANCHORS = 128
#: Weight of the corpus's class frequencies in each state's table.
PRIOR = 100.0
STAY = 0.9
#: Baum-Welch ends when a round gains less than this, in log10 a token; the
#: number of rounds is a guard against a tolerance that is set too small.
TOLERANCE, MOST_ROUNDS = 0.01, 30
#: Characters of the texts of a slice (a longer text has one of its own).
CHARS = 4 << 20
#: Tokens whose state probabilities are held at once (or one document's), and
#: tokens of texts that are sorted by length together.
HELD, TOGETHER = 1 << 18, 1 << 22
#: The end of a text, as a word: no token has white space. It is word 0 of
#: every slice.
END = b" "
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def key_of(word: bytes) -> bytes:
    """What the list of classes knows a word by."""
    return word if len(word) <= KEY_BYTES else hashlib.sha256(word).digest() + END


def key_column(word: str) -> Column:
    return F.when(F.octet_length(word) <= KEY_BYTES, F.col(word)).otherwise(
        F.concat(F.unhex(F.sha2(word, 256)), F.lit(END)))


class Classes:
    """Word classes: frequent words, the end, and the shared ones."""

    def __init__(self, frequent: list[bytes]):
        self.own = {w: i for i, w in enumerate(frequent)}
        self.end = len(frequent)
        self.own[END] = self.end
        self.shared = max(LEAST_SHARED, len(frequent))
        self.n = len(frequent) + 1 + self.shared

    def of(self, words: list[bytes]) -> np.ndarray:
        """Words without a class of their own share one by the last three bytes
        of their letters and the mark that follows these."""
        import xxhash

        own, first, shared, digest, out = self.own, self.end + 1, self.shared, xxhash.xxh64_intdigest, []
        for w in words:
            c = own.get(w if len(w) <= KEY_BYTES else key_of(w))
            if c is None:
                n = len(w.rstrip(PUNCTUATION))
                c = first + digest(w[max(0, n - 3):n + 1]) % shared
            out.append(c)
        return np.array(out, dtype=np.int32)


class Chain:
    """Start, transition (from, to) and emission (class, state) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    def _laid_out(self, sequences: list[np.ndarray]):
        """Sequences longest first, their tokens by place: the documents that
        still go on at a place are a prefix. Returns the order of sequences,
        the classes by place, and where each place begins."""
        lengths = np.array([len(s) for s in sequences])
        order = np.argsort(-lengths, kind="stable")
        places = np.concatenate([np.arange(lengths[i]) for i in order])
        classes = np.concatenate([sequences[i] for i in order])[np.argsort(places, kind="stable")]
        return order, classes, np.concatenate([[0], np.cumsum(np.bincount(places))])

    def _tables(self, parts: list[list[int]], sequences: list[np.ndarray], n: int) -> list[np.ndarray]:
        """``n`` tables of a row a token, for any of the parts: fresh memory for
        each part costs more than the sums in it."""
        most = max((sum(len(sequences[i]) for i in part) for part in parts), default=0)
        return [np.empty((most, len(self.start))) for _ in range(n)]

    def _emitted(self, classes: np.ndarray, out: np.ndarray) -> np.ndarray:
        return np.take(self.emit, classes, axis=0, out=out[:len(classes)], mode="clip")

    def _forward(self, classes: np.ndarray, at: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward values and the scales (probabilities of each token
        given those before it)."""
        alpha, k = self._emitted(classes, out), len(self.start)
        # The last column adds a token's values up.
        moved, now = np.hstack([self.move, np.ones((k, 1))]), self.start[None]
        bounds = at.tolist()
        for low, high in zip(bounds, bounds[1:], strict=False):
            a = alpha[low:high]
            a *= now[:high - low]
            a = a @ moved
            now = a[:, :k] / a[:, k:]
        scale = alpha @ np.ones(k)
        alpha /= scale[:, None]
        return alpha, scale

    def log10_likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probabilities of class sequences (none is empty)."""
        out = np.empty(len(sequences))
        parts = list(_parts(sequences))
        values, = self._tables(parts, sequences, 1)
        for part in parts:
            order, classes, at = self._laid_out([sequences[i] for i in part])
            _, scale = self._forward(classes, at, values)
            logs = np.log10(scale)
            total = np.zeros(len(part))
            for low, high in zip(at.tolist(), at.tolist()[1:], strict=False):
                total[:high - low] += logs[low:high]
            out[np.array(part)[order]] = total
        return out

    def expected(self, sequences: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> float:
        """Adds the expected counts of starts, moves and emissions; the
        sequences' log10 probability."""
        total = 0.0
        parts = list(_parts(sequences))
        values, backward, ahead = self._tables(parts, sequences, 3)
        for part in parts:
            _, classes, at = self._laid_out([sequences[i] for i in part])
            alpha, scale = self._forward(classes, at, values)
            total += float(np.log10(scale).sum())
            # Backward values times emissions, all scaled; a document's last token
            # has backward values of one.
            beta, given, back = backward[:len(classes)], self._emitted(classes, ahead), self.move.T.copy()
            beta[:] = 1.0
            given /= scale[:, None]
            bounds = at.tolist()
            for t in range(len(bounds) - 3, -1, -1):
                low, high, end = bounds[t:t + 3]
                given[high:end] *= beta[high:end]
                np.matmul(given[high:end], back, out=beta[low:low + end - high])
            # The token before each one that is not a document's first.
            first = bounds[1]
            before = np.arange(first, len(classes)) - np.repeat(np.diff(at)[:-1], np.diff(at)[1:])
            gamma = np.multiply(alpha, beta, out=beta)
            start += gamma[:first].sum(axis=0)
            for k in range(gamma.shape[1]):
                emit[:, k] += np.bincount(classes, weights=gamma[:, k], minlength=len(emit))
            earlier = np.take(alpha, before, axis=0, out=beta[:len(before)], mode="clip")
            move += earlier.T @ given[first:] * self.move
        return total


def _parts(sequences: list[np.ndarray]) -> Iterator[list[int]]:
    """Indexes of sequences of like length, about ``HELD`` tokens together."""
    part, size = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: len(sequences[i])):
        if part and size + len(sequences[i]) > HELD:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(sequences[i])
    if part:
        yield part


def vocabulary_of(blob: bytes) -> list[bytes]:
    """Words by number; 0 is the end."""
    return [END, *blob.split(b" ")] if blob else [END]


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as all first bytes, all second ones and so on: small
    numbers have little in the later ones, which compress better apart."""
    return np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def numbers(planes: pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


class Slice:
    """A slice's texts as numbers."""

    def __init__(self, row: dict[str, pa.Scalar]):
        blobs = {name: grown(row[name].as_buffer()) for name in NUMBERS}
        self.vocabulary = vocabulary_of(blobs["vocabulary"].to_pybytes())
        self.tokens = numbers(blobs["tokens"])
        self.lengths = np.frombuffer(blobs["lengths"], "<i4")
        self.held_out = np.frombuffer(blobs["held"], np.uint8).astype(bool)

    def training(self) -> np.ndarray:
        """Tokens of training texts, with their ends."""
        return self.tokens[np.repeat(~self.held_out, self.lengths)]


class Training:
    """A slice's training texts as classes."""

    def __init__(self, classes: pa.Scalar, lengths: pa.Scalar, kind: str):
        self.classes = np.frombuffer(classes.as_buffer(), kind)
        self.lengths = np.frombuffer(lengths.as_buffer(), "<i4")


def cut_up(tokens: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Each text's tokens, the end's at the end."""
    ends = np.cumsum(lengths).tolist()
    return [tokens[low:high] for low, high in zip([0, *ends], ends, strict=False)]


def each_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    for b in batches:
        for i in range(len(b)):
            yield Slice({n: b.column(n)[i] for n in b.schema.names})


NUMBERS = ["vocabulary", "tokens", "lengths", "held"]


class Corpus:
    """What training gathers: slices of texts, counts of their words."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, folds: int, held: int):
        rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"),
                           (remainder(doc_id, folds) == held).alias("held_out"))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 33
            for b in batches:
                done = 0
                for texts in slices(texts_of(b.column(1)), CHARS):
                    words = [words_of(t) for t in texts]
                    numbered = pa.array([w for x in words for w in x], pa.binary()).dictionary_encode()
                    lengths = np.array([len(x) + 1 for x in words])
                    tokens = np.zeros(int(lengths.sum()), "<i4")
                    inner = np.ones(len(tokens), bool)
                    inner[np.cumsum(lengths) - 1] = False
                    tokens[inner] = numbered.indices.to_numpy() + 1
                    part = b.slice(done, len(texts))
                    blobs = (b" ".join(listed(numbered.dictionary)), planes(tokens), lengths.astype("<i4").tobytes(),
                             part.column(2).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
                    ids = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), part.column(0))
                    yield pa.RecordBatch.from_arrays([pa.array([block]), ids, *(pa.array([shrunk(x)], pa.binary()) for x in blobs)],
                                                     names=["block", "doc_ids", *NUMBERS])
                    block, done = block + 1, done + len(texts)

        kind = rows.schema["doc_id"].dataType.simpleString()
        self.slices = written(rows.mapInArrow(
            cut, f"block bigint, doc_ids array<{kind}>, " + ", ".join(f"{c} binary" for c in NUMBERS)), "slices", LARGE_ROWS)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, part in enumerate(each_slice([b])):
                    n = np.bincount(part.training(), minlength=len(part.vocabulary))
                    for low in range(0, len(n), 100_000):
                        high = min(low + 100_000, len(n))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(high - low, b.column("block")[i].as_py())), pa.array(np.arange(low, high), pa.int32()),
                             pa.array(part.vocabulary[low:high], pa.binary()), pa.array(n[low:high], pa.int64())],
                            names=["block", "at", "word", "n"])

        asked = self.slices.select("block", *NUMBERS).mapInArrow(count, "block bigint, at int, word binary, n bigint")
        # A word has a row for each slice, at most.
        # One order for both columns: the rows are sorted once.
        word = Window.partitionBy("word").orderBy("block")
        self.words = written(
            asked.withColumn("c", F.sum("n").over(word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .withColumn("first", F.row_number().over(word) == 1).drop("n"), "words")
        distinct = self.words.filter("first and c > 0")
        row = distinct.agg(F.sum("c"), F.count("*")).first()
        self.tokens, self.distinct = row[0] or 0, row[1]
        frequent = (distinct.filter((F.col("c") >= OWN_SHARE * self.tokens) & (F.col("word") != F.lit(END)))
                    .orderBy(F.desc("c"), "word").select(key_column("word")).collect())
        self.classes = classes = Classes([bytes(r[0]) for r in frequent])
        self.kind = kind = "<u2" if classes.n <= 1 << 16 else "<i4"

        def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in each_slice(batches):
                lengths = part.lengths[~part.held_out]
                if len(lengths):
                    of = classes.of(part.vocabulary).astype(kind)[part.training()]
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (of, lengths)],
                                                     names=["classes", "lengths"])

        # Every pass of the training reads these; the words stay where they are.
        self.training = written(self.slices.select(*NUMBERS).mapInArrow(classed, "classes binary, lengths binary"),
                                "classes", LARGE_ROWS)

    def class_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and distinct words of each class, in the training texts."""
        classes = self.classes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens, distinct = np.zeros(classes.n, np.int64), np.zeros(classes.n, np.int64)
            for b in batches:
                c = classes.of(listed(b.column(0)))
                np.add.at(tokens, c, b.column(1).to_numpy())
                np.add.at(distinct, c, 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes.n)), pa.array(tokens), pa.array(distinct)],
                                             ["class", "tokens", "words"])

        found = (self.words.filter("first and c > 0").select("word", "c")
                 .mapInArrow(run, "class bigint, tokens bigint, words bigint")
                 .groupBy("class").agg(F.sum("tokens"), F.sum("words")).collect())
        tokens, distinct = np.zeros(classes.n, np.int64), np.zeros(classes.n, np.int64)
        for k, t, w in found:
            tokens[k], distinct[k] = t, w
        return tokens, distinct

    def summed(self, rows: int, columns: int, add: Callable[[Iterator[Training], np.ndarray], None]) -> np.ndarray:
        """A table of fixed size, added up over all training texts: ``add`` gets
        the slices of a task and its table."""
        names, kind = [f"s{i}" for i in range(columns)], self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = np.zeros((rows, columns))
            add((Training(*row, kind) for b in batches for row in zip(*b.columns, strict=True)), table)
            used = np.flatnonzero(table.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), *[pa.array(np.ascontiguousarray(c)) for c in table[used].T]], ["row", *names])

        found = (self.training.mapInArrow(run, "row bigint, " + ", ".join(f"{c} double" for c in names))
                 .groupBy("row").agg(*[F.sum(c).alias(c) for c in names]).collect())
        table = np.zeros((rows, columns))
        for r in found:
            table[r[0]] = r[1:]
        return table


def groups_of(company: np.ndarray, states: int) -> np.ndarray:
    """A group for each anchor, from how many texts have two of them: profiles
    of company (cosine, against what frequency alone would give), centres far from
    one another, then the nearest centre, centres moved until nothing changes."""
    texts = np.maximum(np.diag(company), 1.0)
    profile = company / np.sqrt(np.outer(texts, texts))
    profile = profile - profile.mean(axis=0)
    profile /= np.maximum(np.linalg.norm(profile, axis=1), 1e-12)[:, None]
    chosen = [0]
    while len(chosen) < states:
        chosen.append(int((profile @ profile[chosen].T).max(axis=1).argmin()))
    centres, group = profile[chosen], None
    for _ in range(100):
        now = (profile @ centres.T).argmax(axis=1)
        if group is not None and (now == group).all():
            break
        group = now
        centres = np.stack([profile[group == k].mean(axis=0) if (group == k).any() else centres[k] for k in range(states)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1), 1e-12)[:, None]
    return group


def first_guess(corpus: Corpus, usual: np.ndarray, states: int) -> Chain:
    """States from all training texts: anchors (the most frequent words) that
    stand together make a group, a text counts towards the states by the squared
    share of its anchors in each group (all alike without an anchor)."""
    classes = corpus.classes
    anchors = min(ANCHORS, classes.end)
    flat = Chain(np.full(states, 1.0 / states), _stay(states), np.repeat(usual[:, None], states, axis=1))
    if anchors < states:
        # Too few frequent words for a guess: states that differ by a fixed jitter.
        jitter = np.random.default_rng(0).uniform(0.5, 1.5, flat.emit.shape)
        flat.emit = flat.emit * jitter / (flat.emit * jitter).sum(axis=0)
        return flat

    def docs_of(part: Training) -> tuple[np.ndarray, np.ndarray]:
        """Class and text number of each token."""
        return part.classes, np.repeat(np.arange(len(part.lengths)), part.lengths)

    def company(parts: Iterator[Training], table: np.ndarray) -> None:
        for part in parts:
            of, doc = docs_of(part)
            there = of < anchors
            for low in range(0, len(part.lengths), 4096):
                here = there & (doc >= low) & (doc < low + 4096)
                has = np.zeros((4096, anchors), np.float32)
                has[doc[here] - low, of[here]] = 1.0
                table += has.T @ has

    group = groups_of(corpus.summed(anchors, anchors, company), states)

    def lean(parts: Iterator[Training], table: np.ndarray) -> None:
        for part in parts:
            of, doc = docs_of(part)
            share = np.zeros((len(part.lengths), states))
            there = of < anchors
            np.add.at(share, (doc[there], group[of[there]]), 1.0)
            share = (share + 1e-6) ** 2
            share /= share.sum(axis=1, keepdims=True)
            for k in range(states):
                table[:, k] += np.bincount(of, weights=share[doc, k], minlength=classes.n)

    emit = corpus.summed(classes.n, states, lean) + PRIOR * usual[:, None]
    return Chain(np.full(states, 1.0 / states), _stay(states), emit / emit.sum(axis=0))


def _stay(states: int) -> np.ndarray:
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return move


def baum_welch(corpus: Corpus, chain: Chain, usual: np.ndarray) -> tuple[Chain, float]:
    """One round over all training texts: the new chain, and the old one's
    log10 probability of them (of classes)."""
    classes, k = corpus.classes, len(chain.start)

    def add(parts: Iterator[Training], table: np.ndarray) -> None:
        emit, move, start = table[:classes.n], table[classes.n:classes.n + k], table[classes.n + k]
        waiting: list[np.ndarray] = []
        for part in parts:
            waiting += cut_up(part.classes, part.lengths)
            # A place is a step for all texts that go on there: the more long texts
            # together, the fewer steps for each.
            if sum(map(len, waiting)) >= TOGETHER:
                table[-1, 0] += chain.expected(waiting, start, move, emit)
                waiting = []
        table[-1, 0] += chain.expected(waiting, start, move, emit)

    sums = corpus.summed(classes.n + k + 2, k, add)
    emit = sums[:classes.n] + PRIOR * usual[:, None]
    move = sums[classes.n:classes.n + k] + 1.0
    start = sums[classes.n + k] + 1.0
    better = Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return better, float(sums[-1, 0])


def trained(corpus: Corpus, usual: np.ndarray, states: int, tolerance: float = TOLERANCE) -> Chain:
    """Rounds of Baum-Welch until one gains less than ``tolerance`` a token."""
    chain, before = first_guess(corpus, usual, states), None
    for _ in range(MOST_ROUNDS):
        chain, logs = baum_welch(corpus, chain, usual)
        if before is not None and logs - before < tolerance * max(corpus.tokens, 1):
            break
        before = logs
    return chain


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2,
           states: int = STATES, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams), score (the model's log10 probability).

    Learns from rows whose crc32 of the doc_id modulo ``folds`` is not
    ``held`` (a row without doc_id counts as remainder 0). A null text is
    empty: its end alone. Without training texts every word is unseen. Repeated
    rows are texts of their own; an empty table gives an empty result.
    """
    corpus = Corpus(docs, doc_id, text, folds, held)
    classes = corpus.classes
    tokens, distinct = corpus.class_counts()
    usual = (tokens + 1.0) / (tokens.sum() + classes.n)
    chain = trained(corpus, usual, states, tolerance)
    n, v = int(corpus.tokens), int(corpus.distinct)
    # Within a shared class, a place is kept for unseen words.
    room = tokens + distinct + 1
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(block: pa.Table, words: pa.Table) -> pa.Table:
        if not len(block):
            return pa.table({c: pa.array([], t) for c, t in zip(names, kinds, strict=True)})
        row = {c: block[c].combine_chunks()[0] for c in NUMBERS}
        part = Slice(row)
        c = np.zeros(len(part.vocabulary), np.int64)
        c[words["at"].to_numpy()] = words["c"].to_numpy()
        of = classes.of(part.vocabulary)
        base = np.log10((c + 1) / (n + v + 1))
        inside = np.where(of > classes.end, np.log10((c + 1) / room[of]), 0.0)
        starts = np.cumsum(part.lengths) - part.lengths
        # Every text has a token, its end.
        known, unigram, within = (np.add.reduceat(x[part.tokens], starts) for x in ((c > 0).astype(np.int64), base, inside))
        score = chain.log10_likelihoods(cut_up(of[part.tokens], part.lengths)) + within
        ids = block["doc_ids"].combine_chunks().flatten()
        columns = (ids, part.held_out, part.lengths.astype(np.int64), known, np.full(len(ids), n, np.int64), unigram, score)
        return pa.table([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=names)

    element = corpus.slices.schema["doc_ids"].dataType.elementType
    kinds = [to_arrow_type(element), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    # A block is one slice and its words' counts.
    return (corpus.slices.groupBy("block").cogroup(corpus.words.select("block", "at", "c").groupBy("block"))
            .applyInArrow(run, f"doc_id {element.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
                               "train_tokens bigint, base_score double, score double"))
