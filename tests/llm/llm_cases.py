"""Awkward inputs, and results by brute force."""

import collections

import numpy as np

SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
EDGE_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (5, "the quick brown fox jumps over the lazy dog again"),
    (6, "the quick brown fox jumps over the lazy dog again"),
    (6, "the quick brown fox jumps over the lazy dog again"),
    (7, LONG),
    (8, "é̂ ŝ İ Σας 漢字 😀 <|endoftext|> it's  we'LL\r\n\n 12345 ²½ _x_ ' 's  x\x00y"),
    (9, "a " * 400),
    (None, "the quick brown fox jumps over the lazy dog again"),
    (10, "x" * 5000),
]

CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, kept boolean, before string, length string, bands string, size string, `_id` string, part int"


def texts_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def bag_of(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return collections.Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else None


def near_classes(rows):
    """Class of each id by comparing every pair of texts."""
    rows = [(i, bag_of(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(rows):
        for j, b in rows[:x]:
            if a and b:
                common = sum((a & b).values())
                if 5 * common >= 4 * (sum(a.values()) + sum(b.values()) - common):
                    r, s = sorted((root(i), root(j)))
                    parent[s] = r
    return {i: root(i) for i in parent}


def removed_bytes(rows, length=50):
    """(bytes, mask of removed ones) of each row, by a table of every string's first document."""
    first: dict = {}
    for i, t in rows:
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            if i is not None:
                key = data[p : p + length]
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        mask = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            if i is not None and first[data[p : p + length]] < i:
                mask[p : p + length] = True
        out.append((i, data, mask))
    return out


def repeats_of(words, window=5):
    """(words covered by repeats, longest repeat) by trying every length."""
    covered, longest = set(), 0
    for n in range(window, len(words)):
        seen = collections.defaultdict(list)
        for p in range(len(words) - n + 1):
            seen[tuple(words[p : p + n])].append(p)
        again = [p for places in seen.values() if len(places) > 1 for p in places]
        if not again:
            break
        longest = n
        covered.update(w for p in again for w in range(p, p + n))
    return len(covered), longest
