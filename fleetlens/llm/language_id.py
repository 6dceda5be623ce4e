"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A
word's probability in a language is the sum, over all ways to cut it into
pieces, of the product of their probabilities: a forward pass over the word. A
text's is the product over its words (maximal runs of letters, lower case, with
the vocabulary's mark for a word's begin). The prediction is the language with
the highest posterior under the training texts' shares of languages.

The piece probabilities are fitted by expectation-maximisation, from the
expected number of times each piece is used over all segmentations
(forward-backward), on a bounded sample of labelled rows: of each language the
``SAMPLE`` training documents whose hashed doc_id is smallest, whole texts.
"""

from __future__ import annotations

import math
import re
import uuid
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import RecentCache, listed, per_process, remainder, slices, texts_of, vocabulary_path, written

VOCABULARY = "piece_bpe_32k.model"
#: Training documents for each language, at most.
SAMPLE = 300
ROUNDS = 2
#: Added to each piece's expected count.
SMOOTHING = 0.05
#: Cached words, in each of the cache's two generations, and the length of the
#: longest cached one.
WORDS = 75_000
CACHED_LENGTH = 64
#: Characters of the texts whose distinct words are scored together, and new
#: words whose forward passes are: a worker holds the edges of so many.
CHARS, AT_ONCE = 2 << 20, 16_384
UNKNOWN = "und"
BEGIN = "▁"
WORD = re.compile(r"[^\W\d_]+")
#: Forward values are scaled up when they fall below this, in long words.
TINY = 1e-150


def public_pieces(path: str) -> list[str]:
    """The vocabulary's pieces that cover text, and its byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]


def letter_runs(word: str) -> list[str]:
    """Maximal runs of letters: a regular expression's word characters have
    numerals too that are no digits (a half, a superscript)."""
    return [word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split()


def words_of(text: str) -> list[str]:
    return [run for word in WORD.findall(text.lower()) for run in letter_runs(word)]


class Segmenter:
    """All segmentations of words under piece probabilities of languages:
    ``table`` maps a piece to one probability for each."""

    def __init__(self, table: dict[str, tuple[float, ...]], n: int):
        self.n, self.table = n, table
        self.longest = max((len(p) for p in table if not p.startswith("<0x")), default=1)
        self.bytes = [table.get(f"<0x{b:02X}>", (1.0,) * n) for b in range(256)]

    def spelled(self, char: str) -> tuple[float, ...]:
        """A character that is no piece goes by its bytes."""
        return tuple(map(math.prod, zip(*(self.bytes[b] for b in char.encode("utf-8", "replace")), strict=True)))

    def edges(self, word: str) -> list[list[tuple[int, str, tuple[float, ...]]]]:
        """For each end in the marked word: (start, piece, probabilities)."""
        table, longest = self.table, self.longest
        out: list[list[tuple[int, str, tuple[float, ...]]]] = [[] for _ in range(len(word) + 1)]
        for start in range(len(word)):
            if (one := table.get(word[start])) is None:
                out[start + 1].append((start, "", self.spelled(word[start])))
            else:
                out[start + 1].append((start, word[start], one))
            for end in range(start + 2, min(start + longest, len(word)) + 1):
                piece = word[start:end]
                if (p := table.get(piece)) is not None:
                    out[end].append((start, piece, p))
        return out

    def log_likelihoods(self, word: str) -> tuple[float, ...]:
        """Natural logarithms of the word's probability in each language."""
        marked = BEGIN + word
        forward, shift = [(1.0,) * self.n], 0.0
        for end, edges in enumerate(self.edges(marked)[1:], 1):
            total = [0.0] * self.n
            for start, _, p in edges:
                for k, (f, q) in enumerate(zip(forward[start], p, strict=True)):
                    total[k] += f * q
            forward.append(total)
            if max(total) < TINY:
                low = max(0, end - self.longest)
                forward[low:] = [[f / TINY for f in x] for x in forward[low:]]
                shift += math.log(TINY)
        return tuple(math.log(max(f, 1e-300)) + shift for f in forward[-1])

    def expected(self, word: str) -> Iterator[tuple[str, float]]:
        """Expected uses of each piece, of one language (``n`` is 1)."""
        marked = BEGIN + word
        edges = self.edges(marked)
        n = len(marked)
        forward, backward = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        for end in range(1, n + 1):
            forward[end] = sum(forward[start] * p[0] for start, _, p in edges[end])
        for end in range(n, 0, -1):
            for start, _, p in edges[end]:
                backward[start] += p[0] * backward[end]
        if forward[n] > 1e-290:
            for end in range(1, n + 1):
                for start, piece, p in edges[end]:
                    uses = forward[start] * p[0] * backward[end] / forward[n]
                    for name in [piece] if piece else [f"<0x{b:02X}>" for b in marked[start].encode()]:
                        yield name, uses
            return
        # Below a double's range: the same sums of logarithms.
        forward, backward = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        logs = [[(start, piece, math.log(p[0])) for start, piece, p in edges[end] if p[0] > 0] for end in range(n + 1)]
        for end in range(1, n + 1):
            forward[end] = float(np.logaddexp.reduce([-math.inf, *(forward[start] + p for start, _, p in logs[end])]))
        for end in range(n, 0, -1):
            for start, _, p in logs[end]:
                backward[start] = float(np.logaddexp(backward[start], p + backward[end]))
        if forward[n] > -math.inf:  # else no segmentation is possible
            for end in range(1, n + 1):
                for start, piece, p in logs[end]:
                    uses = math.exp(forward[start] + p + backward[end] - forward[n])
                    for name in [piece] if piece else [f"<0x{b:02X}>" for b in marked[start].encode("utf-8", "replace")]:
                        yield name, uses


class LanguageModel:
    """Languages in order, their log shares, and piece probabilities."""

    def __init__(self, languages: list[str], shares: list[float], table: dict[str, tuple[float, ...]]):
        self.languages, self.shares, self.table = languages, shares, table
        self.version = uuid.uuid4().hex


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          vocabulary: str | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> LanguageModel:
    """Fits the model on those of ``docs`` that have a text and a language (and
    a doc_id); of repeated rows of a doc_id and language, on the smallest text."""
    pieces = public_pieces(vocabulary or vocabulary_path(VOCABULARY))
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    # Two steps: the sample's keys first, so that only its texts are gathered.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = (labelled.select("lang", "doc_id").withColumn("place", F.row_number().over(order))
             .filter(F.col("place") <= sample).select("lang", "doc_id").distinct())
    shares = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(shares)
    if not languages:
        return LanguageModel([], [], {})
    # Of a doc_id that repeats, one text: the sample keeps its bound.
    sampled = (labelled.join(F.broadcast(drawn), ["lang", "doc_id"])
               .groupBy("lang", "doc_id").agg(F.min("text").alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = Counter((g, w) for g, t in zip(b.column(1).to_pylist(), b.column(0).to_pylist(), strict=True)
                            for w in words_of(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in found], pa.string()), pa.array([w for _, w in found], pa.string()),
                 pa.array(found.values(), pa.int64())], ["lang", "word", "n"])

    words = written(sampled.select("text", "lang").mapInArrow(count, "lang string, word string, n bigint")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition("word"), "words")
    weights = {g: dict.fromkeys(pieces, 1.0 / len(pieces)) for g in languages}
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            models: dict[str, Segmenter] = {}
            uses: dict[tuple[str, str], float] = defaultdict(float)
            for b in batches:
                for g, w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if g not in models:
                        models[g] = Segmenter({p: (x,) for p, x in weights[g].items()}, 1)
                    for piece, x in models[g].expected(w):
                        uses[g, piece] += n * x
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in uses], pa.string()), pa.array([p for _, p in uses], pa.string()),
                 pa.array(uses.values(), pa.float64())], ["lang", "piece", "uses"])

        # At most a row for each language and piece of the fixed vocabulary.
        found = (words.mapInArrow(expect, "lang string, piece string, uses double")
                 .groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect())
        uses: dict[str, dict[str, float]] = {g: {} for g in languages}
        for r in found:
            uses[r["lang"]][r["piece"]] = r["uses"]
        for g in languages:
            total = sum(uses[g].values()) + SMOOTHING * len(pieces)
            weights[g] = {p: (uses[g].get(p, 0.0) + SMOOTHING) / total for p in pieces}
    everything = sum(shares.values())
    return LanguageModel(languages, [math.log(shares[g] / everything) for g in languages],
                         {p: tuple(weights[g][p] for g in languages) for p in pieces})


class Scorer:
    """Log probabilities of whole texts: the distinct words of a slice of
    texts are scored once, by a bounded cache, and added up by their numbers."""

    def __init__(self, model: LanguageModel):
        n = len(model.languages)
        self.segments, self.shares = Segmenter(model.table, n), np.array(model.shares)
        self.words = RecentCache(WORDS)
        # Row 0: an end of pieces that is none itself.
        self.probabilities = np.array([(0.0,) * n, *model.table.values()])
        self.rows = {p[i:]: 0 for p in model.table for i in range(len(p))}
        self.rows |= {p: i for i, p in enumerate(model.table, 1)}

    def _spell_unknown(self, words: list[str]) -> None:
        unknown = [c for c in set("".join(words)) if not self.rows.get(c)]
        if unknown:
            first = len(self.probabilities)
            self.rows.update({c: first + i for i, c in enumerate(unknown)})
            self.probabilities = np.vstack([self.probabilities, [self.segments.spelled(c) for c in unknown]])

    def _new(self, words: list[str]) -> list[array]:
        """Each word's log probabilities, packed."""
        self._spell_unknown(words)
        short = sorted(w for w in words if len(w) <= CACHED_LENGTH)
        found = {}
        for low in range(0, len(short), AT_ONCE):
            found |= self._forward(short[low:low + AT_ONCE])
        return [found.get(w) or array("d", self.segments.log_likelihoods(w)) for w in words]

    def _forward(self, short: list[str]) -> dict[str, array]:
        """The forward pass over sorted words at once, as a trie: a node's value
        is the sum, over the pieces that its prefix ends with, of the piece's
        probability times the value of the node before it. Edges are listed
        first, then summed by the nodes' depth. A word below a double's range
        is left to the scaled pass."""
        row_of, heads, tails, rows, depths, ends = self.rows.get, [], [], [], [0], []
        path, before = [0], ""
        for word in short:
            marked, shared = BEGIN + word, 0
            for a, b in zip(before, marked, strict=False):
                if a != b:
                    break
                shared += 1
            before = marked
            del path[shared + 1:]
            for end in range(shared + 1, len(marked) + 1):
                node = len(depths)
                depths.append(end)
                path.append(node)
                for start in range(end - 1, -1, -1):
                    row = row_of(marked[start:end], -1)
                    if row > 0:
                        heads.append(node)
                        tails.append(path[start])
                        rows.append(row)
                    elif row < 0:
                        break
            ends.append(path[-1])
        forward = np.ones((len(depths), self.segments.n))
        if heads:
            depth, head, tail, row = map(np.array, (depths, heads, tails, rows))
            order = np.argsort(depth[head], kind="stable")
            bounds = np.searchsorted(depth[head][order], np.arange(1, depth.max() + 2))
            for low, high in zip(bounds, bounds[1:], strict=False):
                at = order[low:high]
                nodes, first = np.unique(head[at], return_index=True)
                forward[nodes] = np.add.reduceat(forward[tail[at]] * self.probabilities[row[at]], first)
        values = forward[ends]
        logs = np.log(np.maximum(values, 1e-300))
        return {w: array("d", x.tobytes()) for w, x, sure in zip(short, logs, values.min(axis=1) > 1e-290, strict=True) if sure}

    def _values(self, words: list[str]) -> np.ndarray:
        """A row a word: log probability in each language, and 1; a word with
        numerals in it has its runs of letters added up, and their number."""
        runs = [letter_runs(w) for w in words]
        distinct = {r for x in runs for r in x}
        long = [r for r in distinct if len(r) > CACHED_LENGTH]
        known = self.words.ready(distinct.difference(long), self._new)
        extra = dict(zip(long, self._new(long), strict=True))
        packed = b"".join(extra.get(r) or known[r] for x in runs for r in x)
        out, counts = np.zeros((len(runs), self.segments.n + 1)), [len(x) for x in runs]
        np.add.at(out[:, :-1], np.repeat(np.arange(len(runs)), counts), np.frombuffer(packed).reshape(-1, self.segments.n))
        out[:, -1] = counts
        return out

    def posteriors(self, texts: Iterable[str]) -> Iterator[np.ndarray | None]:
        """Of each text the languages' probabilities; None without letters."""
        for some in slices(texts, CHARS):
            found = [WORD.findall(t.lower()) for t in some]
            doc = np.repeat(np.arange(len(found)), [len(x) for x in found])
            words = pa.array([w for x in found for w in x], pa.string()).dictionary_encode()
            del found
            values = self._values(listed(words.dictionary))
            codes = words.indices.to_numpy()
            sums = np.stack([np.bincount(doc, values[codes, k], len(some)) for k in range(self.segments.n + 1)], axis=1)
            for row in sums:
                if not row[-1]:
                    yield None
                    continue
                logs = self.shares + row[:-1]
                p = np.exp(logs - logs.max())
                yield p / p.sum()


def predict(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, lang_pred, score (the posterior).

    ``und`` with score 0 if the text is null or has no letter, or if no
    language was learned. Other columns are not read.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_process("language model", lambda: Scorer(model), model.version)
        for b in batches:
            best, scores = [], []
            for p in scorer.posteriors(texts_of(b.column(1))) if model.languages else [None] * len(b):
                best.append(UNKNOWN if p is None else model.languages[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
               folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows
    whose crc32 of the doc_id modulo ``folds`` is not ``held`` (a row without
    doc_id counts as remainder 0). An empty table gives an empty result."""
    model = train(docs.filter(remainder(doc_id, folds) != held), doc_id, text, lang)
    found = predict(docs, model, doc_id, text)
    return found.select("doc_id", (remainder("doc_id", folds) == held).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, least: float = 0.5, doc_id: str = "doc_id", text: str = "text",
                  lang: str = "lang", folds: int = 3, held: int = 1) -> DataFrame:
    """The rows of ``docs`` that have a language: those predicted with a
    posterior of ``least`` or more. Each row is decided by its own text, so
    rows pass with all their columns and need no join."""
    model = train(docs.filter(remainder(doc_id, folds) != held), doc_id, text, lang)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_process("language model", lambda: Scorer(model), model.version)
        for b in batches:
            texts = texts_of(b.column(place))
            found = scorer.posteriors(texts) if model.languages else texts
            keep = [p is not None and p.max() >= least if model.languages else bool(words_of(p)) for p in found]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
