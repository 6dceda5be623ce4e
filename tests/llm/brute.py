"""Plain versions of what the operators compute."""

import hashlib
import math
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import product

import xxhash


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def normalised_sha(text):
    return sha(re.sub("[ \t-\r]+", " ", text))


def simhash(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def components(fps, distance):
    fps = sorted(set(fps))
    return joined(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= distance])


def simhash_groups(texts):
    rows = [(i, simhash(t)) for i, t in texts]
    root = components([f for _, f in rows], 2)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return [(i, f"{f:016x}", least.get(root[f])) for i, f in rows]


def fewest_bins(items, capacity):
    items = sorted(items, reverse=True)

    def fits(i, rooms):
        if i == len(items):
            return True
        return any(r >= items[i] and fits(i + 1, (*rooms[:k], r - items[i], *rooms[k + 1:])) for k, r in enumerate(rooms))

    return next(n for n in range(1, len(items) + 1) if fits(0, (capacity,) * n))


def shingles(text):
    words = [w for w in re.split("[ \t-\r]+", text.lower()) if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def best_sum(word, score):
    @lru_cache(None)
    def best(i):
        return 0.0 if i == len(word) else max(
            score[word[i:j]] + best(j) for j in range(i + 1, len(word) + 1) if word[i:j] in score)

    return best(0)


def log_sum_of_segmentations(word, table, segmenter):
    @lru_cache(None)
    def total(i):
        if i == len(word):
            return 1.0
        one = table.get(word[i]) or segmenter.spelled(word[i])
        return one[0] * total(i + 1) + sum(
            table[word[i:j]][0] * total(j) for j in range(i + 2, len(word) + 1) if word[i:j] in table)

    return math.log(total(0))


def unigram_rows(texts):
    def held(i):
        return zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2

    words = [[*t.encode().lower().split(), b" "] for _, t in texts]
    count = Counter(w for (i, _), x in zip(texts, words) if not held(i) for w in x)
    n, v = count.total(), len(count)
    return [(i, held(i), len(x), sum(w in count for w in x), n,
             round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x), 6)) for (i, _), x in zip(texts, words)]


def hmm_probability(chain, sequence):
    total = 0.0
    for path in product(range(len(chain.start)), repeat=len(sequence)):
        p = chain.start[path[0]]
        for t, (s, c) in enumerate(zip(path, sequence)):
            p *= chain.emit[c, s] * (chain.move[path[t - 1], s] if t else 1.0)
        total += p
    return total
