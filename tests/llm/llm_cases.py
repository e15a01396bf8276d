"""Documents with the awkward cases every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, uid long, key string"
PLAIN = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and river Gauge water, level tide. station été größe año flood record daily mean".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(n):
        word = rng.choice(WORDS) + (str(rng.randrange(400)) if rng.random() < 0.3 else "")
        out.append(word + ("\n" if k % 17 == 16 else " "))
    return "".join(out).strip()


def texts() -> list[str | None]:
    return [
        None, "", " \t\n ", "one", "two words", "A b C d", prose(1, 80), prose(1, 80), prose(1, 80) + " more", prose(2, 300),
        prose(3, 20_000), "spam### " * 90, "same same same same " * 40, "line one is here\n" * 60, prose(4, 120).upper(),
        "<|endoftext|> it's 12 ½ é  x y İstanbul", prose(5, 60), prose(6, 61), prose(7, 62),
    ]


def documents(spark, repeat: int = 1):
    """Clashing extra columns, NULLs in every column, repeated rows and equal texts."""
    rows = []
    for k, text in enumerate(texts()):
        lang, source = ("en", "src0") if k % 3 else (None, None if k % 2 else "src1")
        rows.append((k, text, lang, source, len(text or ""), 0.5, "r", k, "k"))
    rows += [rows[6], rows[6], (None, prose(1, 80), None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows * repeat, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
