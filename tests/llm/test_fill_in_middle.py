from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from railwatch.llm.fill_in_middle import Marks, fill_in_middle, restored
from railwatch.llm.queries import QUERIES
from tests.llm.conftest import SF

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain_form(doc_id, text):
    """(n, form, output, prefix_chars, middle_chars) of one row."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, h1 int, row string")
    got = fill_in_middle(df, **options)
    found = [tuple(r) for r in got.select("doc_id", "n", "form", "output", "prefix_chars", "middle_chars", "restored").collect()]
    wanted = [(d, *plain_form(d, t), t or "") for d, t in rows]
    assert sorted(found, key=key) == sorted(wanted, key=key)


def test_odd_rows(spark, odd_rows):
    check(spark, odd_rows)


def test_marks_and_lookalikes_in_texts(spark):
    texts = ["a <P> b", "<S>", "x<M>", "<", ">", "<P", "P>", "S>M><P<S<M", "<<P", "$1 \\ $2", "(a){2}", "a\r\nb\n", "\n", "𝒳é🙂 z"]
    check(spark, [(1000 + i * 7 + j, t) for i, t in enumerate(texts) for j in range(7)])


def test_very_long_texts(spark):
    """One letter run, one unit per character, and both mixed, of some millions of characters."""
    check(spark, [(1, "a" * 3_000_000), (2, "1 " * 500_000), (3, "ab, " * 400_000), (4, "é" * 500_000)])


def test_empty_table_and_kept_columns(spark, no_docs):
    assert fill_in_middle(no_docs).collect() == []
    got = fill_in_middle(no_docs, keep=("row", "text", "doc_id"))
    assert got.columns[:3] == ["row", "text", "doc_id"]
    with pytest.raises(ValueError, match="cannot be kept"):
        fill_in_middle(no_docs.withColumn("form", F.lit(1)), keep=("form",))


def test_other_marks(spark, odd_docs):
    marks = Marks("$pre^", "[suf\\", "#mid.")
    got = fill_in_middle(odd_docs, marks=marks, plain_from=100, spm_below=50, seed="7", keep=("doc_id", "text"))
    rows = got.withColumn("again", restored(F.col("output"), F.col("form"), marks)).collect()
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert all(r.restored == r.again == (r.text or "") for r in rows)
    assert all(r.form == "plain" or all(m in r.output for m in marks) for r in rows)
    with pytest.raises(ValueError, match="end of a mark"):
        fill_in_middle(odd_docs, marks=Marks("<P>", ">S<", "<M>"))


def test_plan_stays_in_the_jvm_without_shuffle(spark):
    plan = QUERIES["op12_fill_in_middle"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan
    # One match makes the output, one rebuilds each form.
    assert plan.count("regexp_replace(") <= 3
