from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, row long, score string, block int, kind string, lang string"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and very long texts, copies, near copies, shared passages, ties and repeated rows."""
    random.seed(5)
    vocabulary = ["".join(random.choice("abcdeäé") for _ in range(random.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(random.choices(vocabulary, k=n))

    passage, base = prose(60), prose(120)
    near = base.split()
    near[60] = "changed"
    out = [
        (7, base),
        (3, base),
        (12, base.replace(" ", "\n ")),
        (5, " ".join(near)),
        (9, prose(40) + " " + passage + " " + prose(30)),
        (2, passage),
        (30, prose(10) + "\t" + passage),
        (4, prose(50_000)),
        (8, "one two three"),
        (11, "one two three"),
        (13, "x"),
        (14, ("again and " * 200).strip()),
        (15, ""),
        (16, None),
        (17, " \t\n "),
        (18, "日本語 テキスト 🙂 " * 12),
        (19, "日本語 テキスト 🙂 " * 12),
        (20, "###!!@ 123"),
        (21, "a\x00b c\x1fd e"),
    ]
    return out + [(100 + i, prose(random.randint(1, 90))) for i in range(40)]


@pytest.fixture(scope="session")
def odd_rows(rows):
    """With a missing doc_id and a row that is there twice, too."""
    return [*rows, (None, rows[0][1]), (None, None), (6, rows[1][1]), (6, rows[1][1])]


def frame(spark, rows):
    """The documents with more columns, whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, 1, "s", 2, "k", "en") for d, t in rows], SCHEMA).repartition(3, "text")


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(spark):
    """The documents of the smallest given tables as (doc_id, text)."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
