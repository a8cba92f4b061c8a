"""Plain Python versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def quality(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = set()
    for i in range(len(w) - 2):
        if windows[w[i], w[i + 1], w[i + 2]] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if words(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "n_upper": sum("A" <= c <= "Z" for c in text),
    }


def digits(found):
    return re.sub("[^0-9]", "", found)


def luhn(number):
    total = 0
    for k, ch in enumerate(reversed(number)):
        d = int(ch) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda s: all(int(x) <= 255 for x in s.split(".")),
        ),
        (
            "card",
            r"[0-9]([\x20-]?[0-9])+",
            lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)),
        ),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    return [
        (kind, m.start(), m.end())
        for kind, pattern, holds in kinds
        for m in re.finditer(pattern, text or "")
        if holds(m[0])
    ]


def secrets(text):
    any_case = lambda s: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    names = "|".join(map(any_case, ("password", "passwd", "secret", "token")))
    name = f"(?:{names}|{any_case('api')}_?{any_case('key')})"
    kinds = (
        (
            "assign",
            name + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            lambda m: len(m[1]) >= 6,
        ),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    )
    found = [
        (m.start(), k, kind, m.end())
        for k, (kind, pattern, holds) in enumerate(kinds)
        for m in re.finditer(pattern, text or "")
        if holds(m)
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def window_entropy(text, window):
    best = None
    for i in range(len(text) - window + 1):
        counts = Counter(text[i : i + window]).values()
        bits = -sum(c / window * math.log2(c / window) for c in counts)
        best = bits if best is None else max(best, bits)
    return best


def licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    phrases = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
    found = [
        (i, label)
        for phrase, label in phrases
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(w), found


def sha(spans):
    return hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()


def shingles(text, k):
    w = words(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def component_ids(rows, k, percent):
    """rows: (id, text); the smallest id that links reach, by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j < i)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = root(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return [
        (doc_id, len(s), least.get(root(i)) if s else doc_id)
        for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def base_scores(rows):
    """rows: (id, text) -> (id, held_out, n_tokens, n_known, total, score)."""
    tokens = [words(lower(t)) + ["\0end"] for _, t in rows]
    counts = Counter(w for (i, _), ts in zip(rows, tokens, strict=True) if not held_out(i) for w in ts)
    total, scale = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    return [
        (
            i,
            held_out(i),
            len(ts),
            sum(counts[w] > 0 for w in ts),
            total,
            sum(math.log10((counts[w] + 0.5) / scale) for w in ts),
        )
        for (i, _), ts in zip(rows, tokens, strict=True)
    ]


def top_k(rows, queries, k):
    """rows, queries: (id, vector of whole numbers)."""
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    out = []
    for q, qv in dict.fromkeys((i, tuple(v)) for i, v in queries):
        scored = sorted(
            (-sum(a * b for a, b in zip(qv, v, strict=True)), i)
            for i, v in rows
            if i != q and len(v) == len(qv)
        )
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def edf(counts):
    """Slot by slot: the released block that is due earliest."""
    slots, done, order = sum(counts), [0] * len(counts), []
    for t in range(slots):
        due = [
            (-(-(d + 1) * slots // m), s)
            for s, (m, d) in enumerate(zip(counts, done, strict=True))
            if d < m and d * slots // m <= t
        ]
        s = min(due)[1]
        done[s] += 1
        order.append(s)
    return order
