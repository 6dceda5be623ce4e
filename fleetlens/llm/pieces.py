"""SentencePiece encoding and decoding over an Aho-Corasick automaton.

An automaton over all pieces reads the text once. At each position its output
links give every piece that ends there, longest first, and each relaxes the
best score of the position from the one where the piece begins; the pieces on
the best path are the encoding.

What a path may consist of depends on the model's type. In a unigram model
every sequence counts and the score is the sum of the pieces' scores. In a BPE
model only sequences that merging by score yields count: those whose
neighbouring pieces, merged anew from their characters, give the same two
pieces; a piece relaxes a position only if it may follow the last piece of the
path it extends. Each position then has at most one such path, and the result
is the library's.

Text is normalised by the library. It is cut where no piece can cross (before a
run of space marks), and the parts' encodings are cached in each Python worker.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import RecentCache, per_process, slices, vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
SPACE_MARK = "▁"
UNKNOWN_TEXT = " ⁇ "
# Model types in the file, and the penalty of an unknown
# character below the lowest score of a unigram model.
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
#: Cached parts, in each of the cache's two generations, and their length.
CACHE = 300_000
CACHED_LENGTH = 64
#: Pairs of pieces whose merging is remembered.
PAIRS = 500_000


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at:at + size]
            at += size


class Model:
    """A SentencePiece model: pieces by id, scores, type, and normaliser."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        message = {}
        for number, value in fields(proto):
            if number != 1:  # 1: the pieces
                message[number] = dict(fields(value))
        self.type = message.get(2, {}).get(3, UNIGRAM)
        self.prefix = bool(message.get(3, {}).get(3, 1))
        n = lib.vocab_size()
        self.text = [lib.id_to_piece(i) for i in range(n)]
        self.score = [lib.get_score(i) for i in range(n)]
        self.unknown, self.unknown_score = lib.unk_id(), min(self.score) - UNKNOWN_PENALTY
        self.silent = [lib.is_control(i) for i in range(n)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.ids = {self.text[i]: i for i in range(n)
                    if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))}
        #: What a piece adds to a text; None for bytes of longer characters.
        self.shown = ["" if self.silent[i] else self.text[i].replace(SPACE_MARK, " ") for i in range(n)]
        self.shown[self.unknown] = UNKNOWN_TEXT
        for i, b in self.byte_of.items():
            self.shown[i] = chr(b) if b < 128 else None
        #: No piece crosses from other text into a space mark?
        self.parts_apart = all(SPACE_MARK not in p.lstrip(SPACE_MARK) for p in self.ids)
        self.pairs: dict[int, bool] = {}
        self._build()
        self.cache = RecentCache(CACHE)

    def _build(self) -> None:
        """The automaton: transitions, failure links, the piece that a node
        spells, and the nearest node by failure links that spells one."""
        self.go: list[dict[str, int]] = [{}]
        self.spells: list[int] = [-1]
        for piece, i in self.ids.items():
            node = 0
            for char in piece:
                following = self.go[node].get(char)
                if following is None:
                    following = self.go[node][char] = len(self.go)
                    self.go.append({})
                    self.spells.append(-1)
                node = following
            if self.type != BPE or self.merged(piece) == [i]:
                self.spells[node] = i
        self.fail, self.output = [0] * len(self.go), [0] * len(self.go)
        queue = list(self.go[0].values())
        for node in queue:  # grows while it is read: breadth first
            for char, following in self.go[node].items():
                back = self.fail[node]
                while back and char not in self.go[back]:
                    back = self.fail[back]
                self.fail[following] = self.go[back].get(char, 0)
                queue.append(following)
            back = self.fail[node]
            self.output[node] = back if self.spells[back] >= 0 else self.output[back]
        self.length = list(map(len, self.text))

    def merged(self, text: str) -> list[int]:
        """BPE of a short string of known characters, by its definition: merge
        the neighbours whose union scores highest, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], i
            if best is None:
                return [self.ids.get(p, self.unknown) for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, left: int, right: int) -> bool:
        """Does merging the two pieces' text give the same two again?"""
        pair = left * len(self.text) + right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.merged(self.text[left] + self.text[right]) == [left, right]
            self.pairs[pair] = known
        return known

    def best_path(self, text: str) -> list[int]:
        """Piece ids of a part; unknown characters as ``unknown``."""
        n = len(text)
        best: list[float | None] = [None] * (n + 1)
        best[0] = 0.0
        last, begin = [-1] * (n + 1), [0] * (n + 1)
        node, bpe = 0, self.type == BPE
        go, fail, output, spells, length, score = (
            self.go, self.fail, self.output, self.spells, self.length, self.score)
        for end in range(1, n + 1):
            char = text[end - 1]
            while node and char not in go[node]:
                node = fail[node]
            node = go[node].get(char, 0)
            out = node if spells[node] >= 0 else output[node]
            single = False
            while out:
                piece = spells[out]
                start = end - length[piece]
                single = single or start == end - 1
                before = best[start]
                if before is not None:
                    value = before + score[piece]
                    if (best[end] is None or value > best[end]) and (
                            not bpe or last[start] < 0 or self.may_follow(last[start], piece)):
                        best[end], last[end], begin[end] = value, piece, start
                        if bpe:  # no other path is one that merging yields
                            single = True
                            break
                out = output[out]
            if not single and best[end - 1] is not None:  # no piece is this character
                value = best[end - 1] + self.unknown_score
                if best[end] is None or value > best[end]:
                    # -2: nothing merges with it, whatever follows may.
                    best[end], last[end], begin[end] = value, -2, end - 1
        path, end = [], n
        while end:
            path.append((last[end], begin[end]))
            end = begin[end]
        ids: list[int] = []
        for piece, start in reversed(path):
            if piece >= 0:
                ids.append(piece)
            elif self.byte:
                ids.extend(self.byte[b] for b in text[start].encode("utf-8", "surrogatepass"))
            elif not ids or ids[-1] != self.unknown or self.type == BPE:
                ids.append(self.unknown)
        return ids

    def parts(self, normal: str) -> list[str]:
        if not self.parts_apart:
            return [normal] if normal else []
        return re.findall(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+", normal)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit."""
        parts = [self.parts(self.lib.normalize(t)) for t in texts]
        distinct = {p for x in parts for p in x}
        long = [p for p in distinct if len(p) > CACHED_LENGTH]

        def compute(new: list[str]) -> list[bytes]:
            return [np.array(self.best_path(p), dtype="<u4").tobytes() for p in new]

        known = self.cache.ready(distinct.difference(long), compute)
        extra = dict(zip(long, compute(long), strict=True))
        return [b"".join([extra[p] if p in extra else known[p] for p in x]) for x in parts]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, byte pieces as UTF-8, space marks as
        spaces without the one that encoding puts first."""
        text = list(map(self.shown.__getitem__, ids))
        if None in text:
            run = bytearray()
            for at in range(len(ids) - 1, -1, -1):
                if text[at] is None:
                    run.append(self.byte_of[ids[at]])
                    text[at] = ""
                    if at == 0 or text[at - 1] is not None:
                        text[at] = _utf8(bytes(reversed(run)))
                        run.clear()
        joined = "".join(text)
        first = next((self.text[i] for i in ids if not self.silent[i]), "")
        return joined[1:] if self.prefix and first.startswith(SPACE_MARK) else joined


def _utf8(data: bytes) -> str:
    """Bytes as UTF-8; each byte that is part of no character as U+FFFD."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[:e.start].decode() + "�")
            data = data[e.start + 1:]
    return "".join(out)


def model(path: str) -> Model:
    """The worker's model of a file."""
    def load() -> Model:
        with open(path, "rb") as f:
            return Model(f.read())

    return per_process(f"pieces {path}", load)


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per row: doc_id, ids (array<int>). A null text is empty, the
    empty text has no ids; repeated rows give repeated results, an empty table
    an empty one; other columns are not read."""
    path = vocabulary or vocabulary_path(VOCABULARY)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for b in batches:
            texts, low = [t or "" for t in b.column(1).to_pylist()], 0
            for part in slices(texts):
                found = pieces.encode(part)
                ends = np.cumsum([0, *[len(x) // 4 for x in found]]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(low, len(part)), ids], ["doc_id", "ids"])
                low += len(part)

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(docs: DataFrame, doc_id: str = "doc_id", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """One row per row: doc_id, text. Null ids give a null text."""
    path = vocabulary or vocabulary_path(VOCABULARY)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for b in batches:
            for low in range(0, b.num_rows, 512):  # ids are large as Python objects
                part = b.slice(low, 512)
                texts = [None if x is None else pieces.decode(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per row: doc_id, n_pieces, ids_crc32 (unsigned, of the ids as
    little-endian unsigned 32-bit), n_chars and same of the decoded text (same:
    it equals the given one). Rows as in ``encoded``."""
    path = vocabulary or vocabulary_path(VOCABULARY)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for b in batches:
            n, crcs, chars, same = [], [], [], []
            for part in slices([t or "" for t in b.column(1).to_pylist()]):
                for given, ids in zip(part, pieces.encode(part), strict=True):
                    back = pieces.decode(np.frombuffer(ids, dtype="<u4").tolist())
                    n.append(len(ids) // 4)
                    crcs.append(zlib.crc32(ids))
                    chars.append(len(back))
                    same.append(back == given)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(x, pa.int64()) for x in (n, crcs, chars)], pa.array(same, pa.bool_())],
                ["doc_id", "n_pieces", "ids_crc32", "n_chars", "same"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_pieces bigint, "
                               "ids_crc32 bigint, n_chars bigint, same boolean")
