"""Small tables and plain Python versions for the tests of this folder."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "an the or is ti on re wh ing es ed er at st en of nd to it ion ble ly ha sh ou".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def edited(text: str, seed: int, n: int) -> str:
    rng, words = random.Random(seed), text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def documents(spark, texts, extra=False):
    """A documents table; texts are ``text`` or ``(id, text, lang, source)``."""
    rows = [t if isinstance(t, tuple) else (i, t, "en", f"src{i % 3}") for i, t in enumerate(texts)]
    rows = [(*r, len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:  # names that operators use inside
        for name in ("id", "n", "key", "component", "a", "b", "spans", "live", "start", "toxic", "severity", "ids", "words", "cut", "version"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


ODD = [
    None, "", " ", "\n\n", "a", "one two three", "x" * 3000, "Ünïcödé wörds — 漢字 😀 " * 5, "tab\tand\r\nreturn\x0bvertical\x0cform \xa0 nbsp   em",
    "'s it's don't <|endoftext|> <|startoftext|>", "ΑΣ Σ İ ǅ ⅷ ² ª K", prose(1, 60), prose(1, 60), prose(2, 5000),
]


def components(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def jaccard_components(texts: dict, k: int, percent: int) -> dict:
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return components(ids, links)
