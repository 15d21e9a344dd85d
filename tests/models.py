"""Independent statements of the rules, for comparison: set tests and conditions that a result must meet."""

from __future__ import annotations

import unicodedata

SEPARATORS = {"- - -", "---", "***", "* * *"}


def clean(text):
    """Words joined by one space; a separator stays, dashes alone and a lone dot vanish."""
    whole = text or ""
    bare = whole.strip()
    joined = " ".join(whole.split())
    if bare in SEPARATORS:
        return bare
    return "" if set(joined) <= set("- ") or joined == "." else joined


def is_khmer(text):
    """More than three fifths of the counted letters are Khmer."""
    def counted(c):
        kind = unicodedata.category(c)
        in_block = unicodedata.name(c, "").startswith("KHMER ") and ord(c) < 0x1800
        return "khmer" if in_block and (kind[0] in "LN" or c == "\u17d7") else "latin" if kind[0] == "L" and c < "\u0100" else None

    found = [counted(c) for c in text or ""]
    khmer, latin = found.count("khmer"), found.count("latin")
    return 5 * khmer > 3 * (khmer + latin)


def turns_hold(picks, scores, pool):
    """Whether each pair, in order, has the highest score among what earlier pairs left (lower index in ties).

    ``picks``: the sentence of each pair, -1 where nothing was left; ``scores[(pair, sentence)]``.
    """
    for j, u in enumerate(picks):
        free = set(pool) - set(picks[:j])
        rank = {x: (scores[(j, x)], -x) for x in free}
        if (u not in free) if free else (u != -1):
            return False
        if free and any(r > rank[u] for r in rank.values()):
            return False
    return True


def letters_model():
    """Stub sentence model for the encoder plug-in: counts of a..e per text."""
    def encode(texts):
        return [[float(t.lower().count(c)) for c in "abcde"] for t in texts]
    return encode


def unit_model():
    """Stub sentence model whose vectors have length one, so that a merged text is not the sum of its parts."""
    base = letters_model()

    def encode(texts):
        out = []
        for v in base(texts):
            v = [x * x + 0.1 for x in v]
            size = sum(x * x for x in v) ** 0.5
            out.append([x / size for x in v])
        return out
    return encode


def flaky_model():
    """Stub model that fails on any batch holding the word 'boom'."""
    base = letters_model()

    def encode(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("model failure")
        return base(texts)
    return encode
