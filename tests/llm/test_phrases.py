from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st

from railwatch.llm.misra_gries import Summary
from railwatch.llm.phrases import collocations
from railwatch.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_form(rows, least=30, longest=4, covered_percent=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from (doc_id, text, lang)."""
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                count[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        kept = []
        for p, a in found.items():
            if longer[p] and 100 * longer[p] >= covered_percent * a:
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def frame(spark, rows):
    schema = "doc_id long, text string, lang string, f long, block int, phrase string, size int"
    return spark.createDataFrame([(*r, 1, 2, "p", 3) for r in rows], schema).repartition(3, "text")


def check(spark, rows, block_bytes=1 << 20, **options):
    got = collocations(frame(spark, rows), block_bytes=block_bytes, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_form(rows, **options)


ODD = ["A b. a b, a b a", "a\tb  a \t b", "a b\x0ba b\x0c\ra b", "É a é", "a\x00b a\x00b c\x1fd c\x1fd", "日本 語 日本 語", "...", " \t ", "a", "", None]


@pytest.mark.parametrize("least", [1, 2, 5])
def test_odd_rows(spark, odd_rows, least):
    """All n-grams of short texts and those of long ones, by languages and without."""
    langs = ["en", None, "und", "de", ""]
    rows = [(d, t, langs[i % 5]) for i, (d, t) in enumerate(odd_rows) if len(t or "") < 20_000]
    rows += [(i, t, "en") for i, t in enumerate(ODD)]
    check(spark, rows, least=least, top=50)


def test_very_long_text_and_few_kept(spark, odd_rows):
    """The last ranks cut through ties; blocks are so small that the long text has one of its own."""
    check(spark, [(d, t, "x") for d, t in odd_rows], block_bytes=1 << 14, least=4, top=7)


def test_longer_phrases_and_other_shares(spark):
    text = "one two three four five. " * 9 + "one two three four. " * 3 + "two three. " * 5 + "five one. " * 2
    for longest, percent in ((2, 80), (3, 50), (5, 80), (5, 101)):
        check(spark, [(1, text, "en"), (2, text, None)], least=2, longest=longest, covered_percent=percent)


def test_more_than_a_byte_of_counts(spark):
    rows = [(i, "x y " * (i % 40), "en") for i in range(80)]
    for least in (300, 1539, 1540, 1541):
        check(spark, rows, least=least)


def test_empty_table(spark):
    assert collocations(frame(spark, [])).collect() == []


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    got = QUERIES["op13_phrase_collocations"](spark, SF).collect()
    assert sorted(tuple(r) for r in got) == plain_form(rows)
    assert "op13_phrase_collocations" in ORACLES


@settings(max_examples=60, deadline=None)
@examples(st.lists(st.lists(st.integers(0, 60), max_size=60), min_size=1, max_size=12), st.integers(1, 12), st.booleans())
def test_summaries_lose_no_frequent_key(parts, threshold, as_tree):
    """Whatever is merged in which order: no key of the threshold is lost, counters are within the error."""
    true = Counter(x for part in parts for x in part)
    capacity = sum(true.values()) // threshold
    summaries = []
    for part in parts:
        keys, counts = np.unique(np.array(part, np.uint32), return_counts=True)
        s = Summary(capacity)
        s.add(keys, counts)
        summaries.append(s)
    while len(summaries) > 1:
        a, b = summaries.pop(0), summaries.pop(0)
        a._shrink()
        a.merge(b)
        summaries.insert(len(summaries) if as_tree else 0, a)
    (merged,) = summaries
    found = merged.may_reach(threshold).tolist()
    assert merged.mass == sum(true.values())
    assert merged.error * (capacity + 1) <= merged.mass and len(merged.keys) <= max(capacity, 0)
    assert {k for k, n in true.items() if n >= threshold} <= set(found)
    assert all(0 <= true[k] - c <= merged.error for k, c in zip(merged.keys.tolist(), merged.counts.tolist(), strict=True))
