"""A small table of odd documents: nulls, empty and long texts, repeated rows,
copies, near copies, shared passages, and extra columns with clashing names."""

from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "raw string, `set` long, n int, kept boolean, size int, `row` string, spans string, c string, "
          "`order` string, label int, gone_id long, `key` string, quality string, toxic string, held_out string")


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The tables are tiny: shuffles into few tasks (results do not depend on it)."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def sentence(rng, n, letters="etaoinshrdlu"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


def documents():
    """(doc_id, text, lang, source) rows."""
    rng = random.Random(7)
    base = sentence(rng, 120)
    passage = sentence(rng, 60)
    near = base.split(" ")
    near[50] = "changed"
    far = base.split(" ")
    far[10:100:4] = ["other"] * len(far[10:100:4])
    texts = [
        None, "", " \t\n ", "word", "one two three four", "One TWO three four", base, base, " ".join(near),
        " ".join(far), base + " " + sentence(rng, 5), passage + "\n" + sentence(rng, 70), sentence(rng, 90) + " " + passage,
        sentence(rng, 30) + " éè " + passage + " 中文 \U0001F600 " + sentence(rng, 40),
        "ab" * 400, "x" * 150, "ß" * 300, "spam " * 300, "a b c " * 40 + sentence(rng, 100),
        "same line here\n" * 12 + sentence(rng, 60), "### $$$ *** " * 40 + sentence(rng, 30),
        "<|endoftext|> it's they'll 12345 \r\n\x0b\x0c  x y", sentence(rng, 3000), "\n\n\n".join([passage] * 3),
        "\x00zero\x00 byte " * 30, "don't  stop   \n\n  now    ",
    ]
    rows = [(i + 1, t, ("aa", "bb", None)[i % 3], ("s1", "s2", "s3", None)[i % 4]) for i, t in enumerate(texts)]
    rows += [rows[6], rows[11], (None, base, "aa", "s1"), (None, sentence(rng, 80), None, None),
             (99, texts[11], "bb", "s9"), (100, None, None, None)]
    return rows


def frame(spark, rows=None):
    rows = documents() if rows is None else rows
    full = [(*r, None if r[1] is None else len(r[1]), "raw", 1, 2, True, 3, "row", "spans", "c", "order", 9, 10, "key", "q", "t", "h")
            for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def multiset(rows):
    return sorted((tuple(r) for r in rows), key=repr)
