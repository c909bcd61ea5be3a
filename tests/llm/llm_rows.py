"""Rows and helpers that the tests of this folder share."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOC = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("row", T.StringType()), ("node", T.LongType()), ("component_id", T.LongType()))])


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    words = ["".join(random.Random(k).choices(["ka", "lo", "mi", "ter", "ung", "é", "sa"], k=2 + k % 3)) for k in range(vocabulary)]
    out = [words[min(int(r.paretovariate(0.7)), vocabulary) - 1] + ("\n" if r.random() < 0.05 else "") for _ in range(n)]
    return " ".join(out)


def documents() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empties, repeated rows, a null id, a long text, hot lines."""
    base = prose(1, 120)
    near = base.split(" ")
    near[7] = "changed"
    passage = prose(77, 70)
    texts = [base, base, " ".join(near), base + " tail", None, "", " \n\t ", "one", "one two three", "one two three",
             prose(2, 40) + " " + passage + " " + prose(3, 50), passage + "\n" + prose(4, 30), "so " * 400,
             "so " * 390, prose(5, 9000), "word" * 5000, "Ünïcode ▁ 日本 😀 \x00 x\x0by\x1cz"]
    texts += [prose(100 + k, 60 + k) + "\nThe very same line in many of these documents, word for word." for k in range(25)]
    texts += [" ".join(w if k != j else "other" for j, w in enumerate(base.split(" "))) for k in range(20, 40)]
    rows = [(k, t, "en", "s", len(t or ""), "r", 1, 2) for k, t in enumerate(texts)]
    return rows + [rows[0], rows[4], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
