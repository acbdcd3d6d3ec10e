"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

WORDS = ("the of and stone river cloud seven garden letter window market silver paper summer bridge "
         "winter yellow circle number forest").split()
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "`row` string, id string, key int, part string, chunk string, bytes string, "
          "`size` string, spans string, fp string, score string, `__row` string, `__copies` string, "
          "`a.b` string, h string, root string, leader string")
EXTRA = 16


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts() -> list[tuple]:
    """(doc_id, text, source) with nulls, empty, very long, repeated and tied rows."""
    rng = random.Random(5)
    base = prose(rng, 90)
    long = prose(rng, 30_000)
    rows = [(1, base, "b"), (2, base, "b"), (3, base.replace(" ", "  \n"), "b"), (4, base + " extra", "a"),
            (5, None, "a"), (6, "", "a"), (7, " \t\n", None), (None, base, None), (None, None, None),
            (8, long, "c"), (9, long, "c"), (10, long[:-40] + "other ends here", "c"),
            (11, "one", "a"), (12, "ONE", "a"), (13, "word " * 7, "b"), (13, "word " * 7, "b"),
            (14, "Ünïcödé ☃ 🎉 " * 12, "é"), (15, "Ünïcödé ☃ 🎉 " * 12 + "fin", "é"), (16, "x" * 5000, "c"),
            (17, "x" * 4000, "c"), (18, "a\x0bb\x0cc\r\nd", "a"), (19, "abcd", "a"), (20, "\u00a0\u2003a b", "a")]
    rows += [(100 + i, prose(rng, rng.randint(0, 60)), rng.choice("abc")) for i in range(40)]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    clash = ("clash",) * 2
    data = [(i, t, "en", s, None if t is None else len(t), *clash, 3, *("clash",) * (EXTRA - 3)) for i, t, s in rows]
    return spark.createDataFrame(data, SCHEMA)


def table(spark, tmp_path, rows=None, parts: int = 3):
    """The documents as a stored table of several files (row numbers need one)."""
    path = str(tmp_path / "documents.parquet")
    documents(spark, rows).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)
