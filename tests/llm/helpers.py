"""Rows that operators must not stumble over, and the plain versions they are compared with."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: The same documents with columns named like those that the operators make.
CLASHING = DOCS + ", row string, id long, h string, k string, s long, b long, n long, g string, kept string, keep_id string, score string, text_ string"


def messy_docs(seed: int = 7, n: int = 120) -> list[tuple]:
    """Nulls in every column, empty and long texts, repeated rows, near copies, odd characters."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Él", "été", "日本", "it's", "x,y", "!!", "A", "a"]
    base = [[r.choice(vocabulary) for _ in range(r.randint(0, 90))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            if words:
                words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((i, r.choice([" ", "\n", "  "]).join(words), "en", r.choice(["a", "b", "b", None]), 5))
    rows += [(500, None, None, None, None), (501, "", "en", "a", 0), (None, "no id", "en", "a", 5), (None, None, None, None, None),
             (502, "Word " * 30_000, "en", "b", 1), (503, "nospace" * 9_000, "en", "b", 1), (504, "a b c \x1c d<|endoftext|>", "en", "a", 9)]
    return rows + [rows[3], rows[3], (3, "".join(c.upper() if c.isascii() else c for c in rows[3][1]), "en", "a", 1), rows[-1]]


def clashing(rows: list[tuple]) -> list[tuple]:
    return [(*r, "row", 1, "h", "k", 2, 3, 4, "g", "kept", "keep", "score", "t") for r in rows]


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by(rows, *keys):
    return sorted(rows, key=lambda r: tuple((r[k] is None, r[k] if r[k] is not None else 0) for k in keys))
