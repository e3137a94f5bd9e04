"""Plain Python forms of the operators and awkward inputs, for small tables."""

from __future__ import annotations

import re

import xxhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = " \t\n\x0b\x0c\r"


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def odd_rows():
    """Nulls in every column, empty and long texts, repeated rows, shared lines."""
    long = " ".join(f"word{i % 977} of the long text" for i in range(6000))
    same = "A line that many documents share\nand a second one"
    return [
        (1, same, "en", "b", 10),
        (1, same, "en", "b", 10),
        (2, same.upper() + " ", "en", "a", 3),
        (3, None, None, None, None),
        (4, "", "de", "", 0),
        (5, " \t\n ", "de", "a", 4),
        (None, same, None, "c", None),
        (None, None, None, None, None),
        (6, long, "en", "a", len(long)),
        (7, long + " end", "en", None, 1),
        (8, "Grüße aus Köln\r\nGRÜßE aus köln", "de", "b", 1),
        (9, "one", "fr", "c", 3),
        (10, "one two", "fr", "c", 7),
        (11, "퟿ 𝒳𝒴 emoji 🙂 text " * 3, "xx", "a", 1),
    ]


def simhash(text: str | None) -> int:
    found = words(lower(text or ""))
    if not found:
        return 0
    size = min(3, len(found))
    grams = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(prints: dict[object, int], radius: int = 2) -> dict[object, object]:
    """Component by pairwise comparison; keys are document ids."""
    parent = {k: k for k in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in prints}
