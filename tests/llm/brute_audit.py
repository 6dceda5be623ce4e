"""Plain versions of the source audit, run detection and the secret scan."""

import math
import re
import zlib
from collections import Counter, defaultdict

from .brute import sha

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def divergence(rows, min_docs, top=10):
    """Rows are (text, lang, source)."""
    rows = [(t, lang or "", source or "") for t, lang, source in rows]
    docs, used = defaultdict(Counter), defaultdict(Counter)
    for t, lang, source in rows:
        docs[lang].update(set(terms(t)))
        used[lang, source].update(terms(t))
    out = []
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = sorted(s for x, s in used if x == lang)

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // total for t in kept}

        q = shares(sum((used[lang, s] for s in sources), Counter()))
        p = {s: shares(used[lang, s]) for s in sources}

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            own = [(gap(p[s][t], q[t]), t) for t in kept if used[lang, s][t] and p[s][t] > q[t]]
            for part, found, n in (("pair", pairs, len(pairs)), ("term", own, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:n])]
    return out


def stammered(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def runs(words, least=12):
    """(start, length, period) of every run, by trying all periods."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(2 * q, least):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def run_row(doc_id, text):
    words = stammered(doc_id, text)
    found = runs(words)
    start, length, period = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(found), start, length, period, 1000 * length // period if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(words, found)))


ASSIGN = re.compile("(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)


def known_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def bits(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def secret_spans(text, window, classes, allowed):
    """(kind, start, end) of known secrets and of dense candidates."""
    kinds = ("assign", "access", "hex", "entropy")
    base = known_secrets(text)
    out = list(base)
    for m in re.finditer("[A-Za-z0-9+/_=-]{%d,}" % window, text):
        if any(re.search(p, m[0]) for p in allowed) or any(s <= m.start() and e >= m.end() for s, _, e in base):
            continue
        least = next(b for p, b in classes if re.search(p, m[0]))
        if max(bits(m[0][i:i + window]) for i in range(len(m[0]) - window + 1)) >= least - 1e-9:
            out.append((m.start(), 3, m.end()))
    return [(kinds[k], s, e) for s, k, e in sorted(out)]
