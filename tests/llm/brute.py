"""Plain-Python versions of the operators' contracts, and the awkward documents that all of them must handle."""

from __future__ import annotations

import re
from itertools import combinations

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, length int, target string"


def documents() -> list[tuple]:
    """Nulls everywhere, empty, blank and very long texts, repeated rows, near copies, columns with clashing names."""
    base = " ".join(f"wort{k * 7 % 97}" for k in range(120))
    texts = [
        base,
        base.upper(),
        base.replace("wort14", "andere", 1),
        " ".join(base.split()[::-1]),
        "one two",
        "one  two",
        "ONE\ttwo",
        "",
        None,
        " \n\t ",
        "ä ö ü 日本 語 <|endoftext|> x",
        "lone",
        "x " * 30_000 + "y",
        "z" * 200_000,
        base + " tail of some more words here",
    ]
    rows = [(k, t, ("en", "de", None)[k % 3], ("a", "b", None)[k % 3] if k % 4 else "big", len(t) if t is not None else None, "clash", 1, "t") for k, t in enumerate(texts)]
    rows.append((None, "a text without an id", None, None, None, None, None, None))
    rows.append(rows[0])
    rows.append(rows[0])
    return rows


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


def shingle_set(text: str | None, width: int) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def components(rows: list[tuple], width: int, percent: int) -> dict[int, int]:
    """doc_id to the smallest doc_id that it is linked with, directly or not."""
    sets = {r[0]: shingle_set(r[1], width) for r in rows if r[0] is not None}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d in sets}


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def planted(n: int = 60) -> list[tuple]:
    """Documents with chains of near copies around the threshold and a large group of exact copies."""
    import random

    rng = random.Random(5)
    out, k = [], 0
    for group in range(n // 6):
        own = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.choice((12, 60, 200)))]
        for step in range(5):
            out.append((k, " ".join(own), "en", "s", 1, None, None, None))
            k += 1
            own = list(own)
            for _ in range(max(1, len(own) // 50) * step):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
        out.append((k, " ".join(f"free{rng.randrange(10**6)}" for _ in range(80)), "en", "s", 1, None, None, None))
        k += 1
    return out + [(1000 + j, "the same words in every copy of this text", "en", "s", 1, None, None, None) for j in range(40)]
