"""Token counts by heap-and-linked-list byte-pair merging.

Each pre-token is a linked list of byte symbols. A heap holds the adjacent
pairs that may merge by (rank, place); the lowest is popped and merged, and the
pairs it makes with its neighbours are pushed, until none is left. The count is
the initial symbols minus the merges; identifiers are never made.

Words repeat, so counts of pre-tokens are cached in each Python worker, in
caches of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import RecentCache, per_process, slices, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Cached words and pre-tokens, in each of a cache's two generations.
CACHE = 300_000
#: Longer ones are counted anew each time, so that the caches stay small.
CACHED_LENGTH = 64

# The pattern that byte-level BPE splits text by.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    """The merge ranks of a byte-level BPE vocabulary file (.json)."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: bytes([b]) for b, c in byte_letters().items()}
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[b"".join(map(byte_of.__getitem__, left)), b"".join(map(byte_of.__getitem__, right))] = rank
        self.symbols = [bytes([b]) for b in range(256)]
        self.split = regex.compile(PRE_TOKEN).findall
        special = [t["content"] for t in spec["added_tokens"]]
        #: Special strings in a text are one token each, as the library reads them.
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in special) + ")") if special else None
        self.special_texts = special
        self.words, self.pre_tokens = RecentCache(CACHE), RecentCache(CACHE)

    def merged_count(self, data: bytes) -> int:
        """Symbols of one pre-token that are left after all merges."""
        n = len(data)
        if n < 2:
            return n
        ranks = self.ranks
        symbol = list(map(self.symbols.__getitem__, data))
        heap = [(r, i) for i, pair in enumerate(zip(symbol, symbol[1:], strict=False))
                if (r := ranks.get(pair)) is not None]
        heapq.heapify(heap)
        following, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            rank, i = heapq.heappop(heap)
            left = symbol[i]
            if left is None or (j := following[i]) >= n or ranks.get((left, symbol[j])) != rank:
                continue  # one of the two has merged with another meanwhile
            symbol[i] = left = left + symbol[j]
            symbol[j] = None
            following[i] = k = following[j]
            merges += 1
            if k < n:
                before[k] = i
                if (r := ranks.get((left, symbol[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get((symbol[h], left))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merges

    def count_plain(self, text: str) -> int:
        """Tokens of a text without special strings, by its pre-tokens."""
        return sum(self.merged_count(p.encode()) for p in self.split(text))

    def _counts_of(self, words: list[str]) -> list[int]:
        parts = [self.split(w) for w in words]
        known = self.pre_tokens.ready({p for x in parts for p in x},
                                      lambda new: [self.merged_count(p.encode()) for p in new])
        return [sum(map(known.__getitem__, x)) for x in parts]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text."""
        plain, extra = [], []  # words of each text; tokens found otherwise
        for text in texts:
            if self.special is not None and any(t in text for t in self.special_texts):
                pieces = self.special.split(text)
                extra.append(len(pieces) // 2 + sum(map(self.count_plain, pieces[::2])))
                plain.append([])
            else:
                words = spaced_words(text)
                extra.append(sum(self.count_plain(w) for w in words if len(w) > CACHED_LENGTH))
                plain.append([w for w in words if len(w) <= CACHED_LENGTH])
        known = self.words.ready({w for x in plain for w in x}, self._counts_of)
        return [sum(map(known.__getitem__, x)) + more for x, more in zip(plain, extra, strict=True)]


def spaced_words(text: str, mark: str = " ") -> list[str]:
    """Parts of a text that no pre-token crosses, in order; all but the first
    with ``mark`` for the space before them.

    A space between two visible characters always begins a pre-token, so the
    text is cut before each of them; runs of several white-space characters
    stay in one part.
    """
    if needs_care(text):
        first, *rest = re.split(r"(?<=\S) (?=\S)", text)
    else:
        first, *rest = text.split(" ")
    return [first, *([mark + w for w in rest] if mark else rest)]


#: All white space that a regular expression's ``\\s`` may match.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
ASCII_WHITE = "".join(c for c in WHITE if c.isascii())


def needs_care(text: str) -> bool:
    """Does a space touch other white space?"""
    return any(" " + c in text or c + " " in text for c in (ASCII_WHITE if text.isascii() else WHITE))


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    ``vocabulary`` is the path of a byte-level BPE .json file. A null text is
    empty: no bytes, no tokens. Repeated rows give repeated results, an empty
    table an empty one; other columns are not read.
    """
    path = vocabulary or vocabulary_path(VOCABULARY)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = per_process(f"merges {path}", lambda: Merges(path))
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            counts = [n for part in slices(texts) for n in merges.count(part)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
