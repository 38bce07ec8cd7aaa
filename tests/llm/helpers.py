"""Small tables with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

SPACES = r"[\x20\x09-\x0D]"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
EXTRA = ["row", "id", "text_", "norm", "h", "salt", "run", "n", "node", "version", "words", "pos", "key", "p", "kept", "_place"]


def documents(spark, rows, extra: bool = True):
    """rows: (doc_id, text[, lang, source]). With columns whose names the operators might use."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    schema = SCHEMA
    if extra:
        full = [r + tuple(range(len(EXTRA))) for r in full]
        schema += "".join(f", `{name}` long" for name in EXTRA)
    return spark.createDataFrame(full, schema).repartition(3)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    names = [f"w{i:x}" for i in range(vocabulary)]
    return " ".join(rng.choice(names) + ("\n" if rng.random() < 0.05 else "") for _ in range(words))


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls, empty and white-space texts, one long text, ties, repeated rows, near and exact copies."""
    base, shared = prose(seed, 120), "this line is shared by many of the documents"
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "one", "de", None), (5, "One ", "de", "b"),
        (6, base, "en", "a"), (7, base, "en", "a"), (7, base, "en", "a"), (8, base.replace(" ", "\t"), "fr", "c"),
        (9, base + " tail of five new words", "en", "b"), (10, prose(seed + 1, 6000), "en", "long"),
        (11, shared, "en", "b"), (12, "x\n" + shared.upper() + "  \ny", "en", "b"), (13, shared + "\n" + shared, "en", "c"),
        (14, shared + "\nshort", None, "c"), (None, base, "en", "a"), (None, None, None, None), (15, "ünï çode 💥 " * 9, "fr", "z"),
    ]
    return rows + [(100 + i, prose(seed + 10 + i, 30 + i), "en", f"s{i % 4}") for i in range(20)]


def shingles(text: str | None) -> set:
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def components(texts: dict) -> dict:
    """Smallest reachable id by links of similarity 0.75 or more."""
    sets, parent = {k: shingles(t) for k, t in texts.items()}, {k: k for k in texts}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}
