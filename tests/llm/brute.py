"""Plain versions of the operators that SQL cannot express."""

import re
import zlib

import numpy as np

SPANS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def span_holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in SPANS.items()
        for m in pattern.finditer(text or "")
        if span_holds(kind, m.group())
    ]


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_duplicates(rows, k, percent):
    """{id: (set size, component)}"""
    sets = [(i, shingles(t, k)) for i, t in rows]
    links = [
        (i, j)
        for n, (i, a) in enumerate(sets)
        for j, b in sets[:n]
        if a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    found = components({i for i, _ in rows}, links)
    return {i: (len(s), found[i]) for i, s in sets}


def vector_links(rows, threshold):
    """{id: (links, component)} of (id, vector, label) rows."""
    good = [
        (i, np.asarray(v, np.float64), label)
        for i, v, label in rows
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for n, (i, a, x) in enumerate(good):
        for j, b, y in good[:n]:
            if x == y and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links.append((i, j))
    found = components({r[0] for r in rows}, links)
    return {r[0]: (sum(r[0] in pair for pair in links), found[r[0]]) for r in rows}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
