"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return; as extra columns they must not get in the way.
CLASHING = ["size", "shard", "k", "h", "data", "fp", "length", "rank", "score", "_k", "_n", "component", "taken", "copies"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def texts() -> list[str | None]:
    """Some sixty texts with copies, near copies, shared lines and passages, and odd ones."""
    rng = random.Random(7)
    made = [words(rng, rng.randrange(1, 160)) for _ in range(30)]
    passage = words(rng, 60)
    long = words(rng, 9000)
    near = made[3].split()
    near[len(near) // 2] = "changed"
    lines = "\n".join(words(rng, 9) for _ in range(6))
    return [
        *made, made[0], made[0], made[1], " ".join(near), f"{made[4]} {passage} {made[5]}", f"{made[6]}\n{passage}", passage,
        long, long[:-1] + "z", lines, lines.upper(), lines.replace("a", "b", 1), lines.replace("c", "", 2), None, None, "",
        "", " ", "\n\n \t", "a", "é", "one two", "one  two\tthree\n\nfour", "same line of more than twenty four characters",
        "same line of more than twenty four character", "same line of mere than twenty four characterz",
        "the same words " * 40, "日本語 テキスト 😀 ümlaut", "x" * 5000, "<|endoftext|> special", "#*$ %&| <> !!",
    ]


def docs(spark: SparkSession, extra: bool = True) -> DataFrame:
    """The texts as documents: one source holds a third of them, two rows have no id, one row is there twice."""
    rng = random.Random(8)
    sources = ["s1", "s2", "é", "a", None]
    rows = [(i, t, "en", "hot" if i % 3 == 0 else rng.choice(sources), len(t or "")) for i, t in enumerate(texts())]
    rows += [(None, "no id, some words of text that is not short", None, None, None), (None, None, "en", "s1", 0), rows[2]]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
