"""Whole texts to token ids with the tokenizers library, by distinct words.

The library needs about ten microseconds a word; words repeat. A slice of texts
is cut where no token can cross, Arrow numbers its distinct parts, each of them is
encoded once, and the texts' ids are gathered from the parts' by their numbers.
A part that is a word with ASCII punctuation behind it is two pre-tokens, which
the library encodes each by itself. Any other part is encoded as it is. Words and
other parts are looked up in bounded caches, which live in the Python worker from
slice to slice.
"""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fleetlens.llm.bpe import WHITE, spaced_words
from fleetlens.llm.common import RecentCache, listed, per_process, slices, tokenizer

#: Cached words and other parts, in each of a cache's two generations, and the
#: length of the longest cached one.
WORDS, ODD = 300_000, 50_000
CACHED_LENGTH = 64
#: Words that go to the library as one text.
LINE = 256
#: Characters of the texts whose distinct parts are encoded together: the more,
#: the fewer parts for each of them.
CHARS = 6 << 20

_WHITE = "".join(rf"\x{{{ord(c):x}}}" for c in WHITE)
#: A space beside other white space; a line end between two visible characters,
#: which is a pre-token of its own.
TOUCHING, LINE_END = f" [{_WHITE}]|[{_WHITE}] ", f"([^{_WHITE}])\n([^{_WHITE}])"


class ByteLevel:
    """Byte-level BPE without normaliser: cut before single spaces, which
    belong to the word behind them, and before single line ends."""

    between = "\n"

    @staticmethod
    def cut(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct parts, the parts of all texts by number, and how many each
        text has. Arrow cuts the texts in which no space touches white space."""
        column = pa.array(texts, pa.string())
        careful = pc.match_substring_regex(column, TOUCHING)
        lists = pc.split_pattern(pc.replace_substring_regex(column.filter(pc.invert(careful)), LINE_END, "\\1 \n\\2"), " ")
        if (care := careful.to_numpy(zero_copy_only=False)).any():
            others = pa.array([spaced_words(t, "") for t in column.filter(careful).to_pylist()], lists.type)
            place = np.argsort(np.append(np.flatnonzero(~care), np.flatnonzero(care)))
            lists = pa.concat_arrays([lists, others]).take(pa.array(place))
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        numbered = lists.flatten().dictionary_encode()
        codes, parts = numbered.indices.to_numpy().astype(np.int64), numbered.dictionary
        # The space cut off belongs to the part behind it; a text's first part has
        # none, and a line end in front of a part stands for itself.
        at = np.cumsum(sizes) - sizes
        firsts, first = np.unique(codes[at], return_inverse=True)
        codes[at] = len(parts) + first
        marks = pc.if_else(pc.starts_with(parts, "\n"), "", " ")
        return pa.concat_arrays([pc.binary_join_element_wise(marks, parts, ""), parts.take(pa.array(firsts))]), codes, sizes

    @staticmethod
    def plain(words: pa.Array) -> np.ndarray:
        """Which are one pre-token of letters, behind a space or a line end?"""
        return pc.match_substring_regex(words, r"^[ \n]?\p{L}+$").to_numpy(zero_copy_only=False)


class Words:
    """BPE over lower-case words that drops white space."""

    between = "|"

    @staticmethod
    def cut(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        # Special strings are matched before the library lowers letters.
        cut = [(data if b"<|" in data else data.lower()).split() for data in map(str.encode, texts)]
        sizes = np.array([len(x) for x in cut])
        numbered = pa.array(list(chain.from_iterable(cut)), pa.binary()).dictionary_encode()
        return numbered.dictionary.cast(pa.string()), numbered.indices.to_numpy().astype(np.int64), sizes

    @staticmethod
    def plain(words: pa.Array) -> np.ndarray:
        """Which are one pre-token of letters after the file's normaliser
        (NFC, then lower case)? Some letters become a letter and a mark."""
        return np.array([w.isalpha() and (w.isascii() or unicodedata.normalize("NFC", w).lower().isalpha())
                         for w in listed(words)], bool)


class Encoder:
    """Ids of whole texts, each text's as little-endian unsigned 32-bit."""

    def __init__(self, scheme: ByteLevel | Words, path: str):
        self.scheme, self.lib = scheme, tokenizer(path)
        [self.separator] = self.lib.encode(scheme.between, add_special_tokens=False).ids
        self.words, self.odd = RecentCache(WORDS), RecentCache(ODD)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, many to a text: the separator between them
        is a pre-token of its own, with an id that no letters give. A line whose
        separators do not all come back alone goes word by word. A separator
        before a word is one, too."""
        between, out = self.scheme.between, []
        behind = [w.startswith(between) for w in words]
        alone = np.array([self.separator], "<u4").tobytes()
        words = [w.removeprefix(between) for w in words]
        lines = [words[i:i + LINE] for i in range(0, len(words), LINE)]
        found = self.lib.encode_batch_fast([between.join(x) for x in lines], add_special_tokens=False)
        for line, e in zip(lines, found, strict=True):
            ids = np.array(e.ids, dtype="<u4")
            data, start = ids.tobytes(), 0
            cuts = np.flatnonzero(ids == self.separator)
            if len(cuts) != len(line) - 1:
                out += self._whole(line)
                continue
            for end in (4 * np.append(cuts, len(ids))).tolist():
                out.append(data[start:end])
                start = end + 4
        return [alone + ids if b else ids for ids, b in zip(out, behind, strict=True)]

    def _encoded(self, parts: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of pieces, and for each part the numbers of its two: its word
        and the punctuation behind it (0: none), or the part as a whole."""
        trimmed = pc.utf8_rtrim(parts, string.punctuation)
        cores = trimmed.dictionary_encode()
        plain = self.scheme.plain(cores.dictionary)
        plain &= pc.less_equal(pc.utf8_length(cores.dictionary), CACHED_LENGTH).to_numpy(zero_copy_only=False)
        words = listed(cores.dictionary.filter(pa.array(plain)))
        known = self.words.ready(set(words), self._lines)
        pieces = [b"", *map(known.__getitem__, words)]
        core = cores.indices.to_numpy()
        is_plain = plain[core]
        first, second = np.cumsum(plain)[core], np.zeros(len(core), np.int64)
        # Punctuation is ASCII: as many characters as bytes.
        cut = pc.subtract(pc.binary_length(parts), pc.binary_length(trimmed)).to_numpy()
        some = np.flatnonzero(is_plain & (cut > 0))
        tails = pa.array([p[-n:] for p, n in zip(listed(parts.take(pa.array(some))), cut[some].tolist(), strict=True)],
                         pa.string()).dictionary_encode()
        second[some] = len(pieces) + tails.indices.to_numpy()
        pieces += self._whole(listed(tails.dictionary))
        rest = np.flatnonzero(~is_plain)
        odd = listed(parts.take(pa.array(rest)))
        short = self.odd.ready({p for p in odd if len(p) <= CACHED_LENGTH}, self._whole)
        long = [p for p in odd if len(p) > CACHED_LENGTH]
        found = dict(zip(long, self._whole(long), strict=True))
        first[rest] = len(pieces) + np.arange(len(rest))
        pieces += [short[p] if len(p) <= CACHED_LENGTH else found[p] for p in odd]
        return pieces, np.stack([first, second], axis=1)

    def _slice(self, texts: list[str]) -> Iterator[bytes]:
        parts, codes, sizes = self.scheme.cut(texts)
        pieces, of = self._encoded(parts)
        lengths = np.array([len(x) // 4 for x in pieces], np.int64)
        pool, starts = np.frombuffer(b"".join(pieces), "<u4"), np.cumsum(lengths) - lengths
        # Piece after piece, the places of its ids in the pool.
        which = of[codes].ravel()
        n = lengths[which]
        behind = np.append(0, np.cumsum(n))
        ids = pool[np.repeat(starts[which] - behind[:-1], n) + np.arange(behind[-1])]
        ends = behind[2 * np.cumsum(sizes)].tolist()
        del parts, codes, pieces, of, pool, which, n
        for start, end in zip([0, *ends], ends, strict=False):
            yield ids[start:end].tobytes()

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        for some in slices(texts, CHARS):
            yield from self._slice(some)
            pa.default_memory_pool().release_unused()


def encoder(scheme: Callable[[], ByteLevel | Words], path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return per_process(f"encoder {path}", lambda: Encoder(scheme(), path))
