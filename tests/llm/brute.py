"""Plain versions of what the operators compute."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(rnd, n, size=3000):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k: int, num: int, den: int) -> list:
    """(doc_id, n_shingles, component) of each row (doc_id, text), sorted; texts: a dict or pairs. Rows of one doc_id are one document."""
    rows = list(rows.items()) if isinstance(rows, dict) else list(rows)
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            both = len(x & y)
            if x and y and i is not None and j is not None and den * both >= num * (len(x) + len(y) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return sorted(((i, len(x), None if i is None else find(i) if x else i) for i, x in sets), key=repr)


def repeated(texts: dict, least: int) -> dict:
    """Words of each document that lie in a run of `least` words which an earlier document has."""
    first, out = {}, {}
    for i in sorted(texts):
        w = WORD.findall(texts[i] or "")
        for j in range(len(w) - least + 1):
            first.setdefault(tuple(w[j : j + least]), i)
    for i in sorted(texts):
        w = WORD.findall(texts[i] or "")
        for j in range(len(w) - least + 1):
            if first[tuple(w[j : j + least])] < i:
                out.setdefault(i, set()).update(range(j, j + least))
    return out


def measures(text):
    t = text or ""
    w = WORD.findall(t)
    g = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + j for i in range(len(w) - 2) if g[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)
