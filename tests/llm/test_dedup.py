from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from railwatch.llm import bwt, chosen_path, exact_dedup, repeated_bytes, repeated_windows
from railwatch.llm import exchange as X
from railwatch.llm import text as T
from railwatch.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.conftest import SF


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def expected(rows):
    return sorted(rows, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact(docs, rows):
    assert got(exact_dedup.exact_duplicates(docs), *EXACT) == expected(brute.exact(rows))


@pytest.mark.parametrize("fan_in", [2, 3])
def test_exact_is_the_same_by_any_tree(odd_docs, odd_rows, fan_in):
    found = got(exact_dedup.exact_duplicates(odd_docs, rows_per_task=5, fan_in=fan_in), *EXACT)
    wanted = expected(brute.exact(odd_rows))
    # Which of two like rows stays depends on where they stand.
    assert sorted((r[:3] + r[4:] for r in found), key=repr) == sorted((r[:3] + r[4:] for r in wanted), key=repr)
    assert sum(r[3] for r in found) == sum(r[3] for r in wanted)


def test_exact_keeps_one_row_of_each(odd_docs, odd_rows):
    kept = exact_dedup.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({brute.re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in odd_rows})


def test_exact_query_and_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = con.execute(f"SELECT {', '.join(EXACT)} FROM ({ORACLES['op5_exact_dedup']})").fetchall()
    assert got(QUERIES["op5_exact_dedup"](spark, SF), *EXACT) == expected(sql)


WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("window", [2, 5, 20])
def test_windows(docs, rows, window):
    df = repeated_windows.remove_repeats(docs, window=window, block_bytes=2000)
    assert got(df, *WORDS) == expected(brute.repeated_words(rows, window))


def test_windows_of_odd_rows(odd_docs, odd_rows):
    assert got(repeated_windows.remove_repeats(odd_docs), *WORDS) == expected(brute.repeated_words(odd_rows, 20))


def test_windows_query(spark, given):
    assert got(QUERIES["op6_substring_dedup"](spark, SF), *WORDS) == expected(brute.repeated_words(given, 20))


def test_windows_shuffle_no_texts(docs):
    plan = repeated_windows.remove_repeats(docs, block_bytes=2000)._jdf.queryExecution().executedPlan().toString()
    above, found, _ = plan.partition("railwatch_blocks")
    assert found and "Exchange" not in above


def test_blocks_are_dealt_as_they_come(docs, rows):
    limit = 2000
    stored = X.stored_blocks(docs.select("doc_id", "text"), 5, limit)
    assert got(stored, "doc_id", "text") == expected(rows)
    longest = max(len((t or "").encode()) for _, t in rows)
    sizes = [r.n for r in stored.selectExpr("block", "octet_length(text) n").groupBy("block").agg({"n": "sum"}).toDF("block", "n").collect()]
    assert len(sizes) > 5 and max(n or 0 for n in sizes) < limit + longest


def test_sketch_never_estimates_too_low():
    import numpy as np

    cells = np.random.default_rng(0).integers(0, 1 << 32, 5000, dtype=np.uint32)
    a, b = repeated_windows.sketch_places(cells)
    assert max(a.max(), b.max()) < 1 << repeated_windows.SKETCH_BITS
    assert (repeated_windows.sketch_places(cells)[0] == a).all() and (a != b).any()


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("length", [35, 50])
def test_bytes(docs, rows, length):
    df = repeated_bytes.remove_repeats(docs, length=length, block_bytes=3000, shard_bytes=700)
    assert got(df, *BYTES) == expected(brute.repeated_bytes(rows, length))


def test_bytes_of_odd_rows(odd_docs, odd_rows):
    assert got(repeated_bytes.remove_repeats(odd_docs), *BYTES) == expected(brute.repeated_bytes(odd_rows, 50))


def test_bytes_with_hot_minimizers(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "HOT_STRETCHES", 1)
    df = repeated_bytes.remove_repeats(odd_docs, block_bytes=3000, shard_bytes=700)
    assert got(df, *BYTES) == expected(brute.repeated_bytes(odd_rows, 50))


def test_copies_by_id_and_text(spark):
    a, b = ("some words of the first text " * 4).strip(), ("other parts in a second piece " * 4).strip()
    docs = spark.createDataFrame([(3, a), (7, a), (7, b)], "doc_id long, text string")
    found = repeated_bytes.remove_repeats(docs.coalesce(1), block_bytes=1 << 20)
    blocked = pa.table({"doc_id": [7, 7], "text": [a, b]})
    copies = {7: {repeated_bytes._digest(np.frombuffer(a.encode(), np.uint8))}}
    assert repeated_bytes._Stretches(blocked, copies, 50).is_copy.tolist() == [True, False]
    assert got(found, "doc_id", "n_removed") == expected([(3, 0), (7, len(a)), (7, 0)])


def test_hot_stretches_are_spread_over_slices():
    random = np.random.default_rng(1)
    phrase = b"a phrase that they all have."
    own = random.integers(97, 123, (500, 2, 30)).astype(np.uint8)
    docs = pa.table({"doc_id": list(range(500)), "text": [(a.tobytes() + phrase + b.tobytes()).decode() for a, b in own]})
    s = repeated_bytes._Stretches(docs, {}, 50)
    cell, count = np.unique(s.cells(16), return_counts=True)
    hot = s.cells(16) == cell[count.argmax()]
    assert hot.sum() >= 100
    window = s.split(hot, 50)
    places = np.bincount((s.cells(16)[window] >> np.uint64(32)).astype(int), minlength=16)
    assert places.max() < 2 * places.mean()


def test_bytes_query(spark, given):
    assert got(QUERIES["op7_suffix_array_dedup"](spark, SF), *BYTES) == expected(brute.repeated_bytes(given, 50))


def test_merged_transforms_order_all_suffixes():
    import numpy as np

    from railwatch.llm import bwt

    random = np.random.default_rng(2)
    strings = [bytes(random.integers(97, 99, random.integers(1, 60), dtype=np.uint8)) for _ in range(80)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    for depth in (5, 25, 50):
        whole = bwt.transform(data, at, 0, depth)
        merged = bwt.merge_all(data, at, depth, shard_bytes=300)
        for t in (whole, merged):
            prefix = [strings[s][p : p + depth] for s, p in zip(t.string, t.place, strict=True)]
            assert prefix == sorted(prefix) and len(prefix) == len(data)
            assert [a == b for a, b in zip(prefix[1:], prefix, strict=False)] == (t.same[1:] == t.same[:-1]).tolist()
        there = merged.further >= 0
        on = merged.further[there]
        assert (merged.string[on] == merged.string[there]).all() and (merged.place[on] == merged.place[there] + bwt.UNIT).all()


LINKS = ("doc_id", "class_id", "n_links")


def test_join(docs, rows):
    assert got(chosen_path.similar_documents(docs), *LINKS) == expected(brute.similar(rows))


def test_join_of_odd_rows(odd_docs, odd_rows):
    assert got(chosen_path.similar_documents(odd_docs), *LINKS) == expected(brute.similar(odd_rows))
    kept = chosen_path.keep_one_per_class(odd_docs)
    assert kept.columns == odd_docs.columns


def test_join_query(spark, given):
    assert got(QUERIES["op10_jaccard_join"](spark, SF), *LINKS) == expected(brute.similar(given))


def test_join_of_a_large_group(spark, monkeypatch):
    """Buckets over the size for brute force are split by further places, and compared in cells of small chunks."""
    import random

    random.seed(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        w = list(base)
        w[random.randrange(200)] = f"other{i}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(chosen_path, "SMALL", 20)
    from tests.llm.conftest import frame

    df = chosen_path.similar_documents(frame(spark, rows))
    assert got(df, *LINKS) == expected(brute.similar(rows))


def test_sketch_bound_follows_the_similarity(docs):
    assert chosen_path.sketch_agrees(0.8) >= 28 > chosen_path.sketch_agrees(0.6)
    for similarity in (0.55, 0.8, 0.95):
        bound = chosen_path.sketch_agrees(similarity)
        found = np.random.default_rng(0).binomial(chosen_path.PLACES, similarity, 100_000)
        assert (found >= bound).all()
    for similarity in (0.0, 0.5, 1.0):
        with pytest.raises(ValueError):
            chosen_path.similar_documents(docs, similarity)


def test_runs_reach_the_recall():
    assert chosen_path.runs_needed(recall=0.9999) > chosen_path.runs_needed(recall=0.9)
    assert chosen_path.runs_needed(levels=1) < chosen_path.runs_needed(levels=4) < 30


def test_empty_tables(no_docs):
    for df in (
        exact_dedup.exact_duplicates(no_docs),
        repeated_windows.remove_repeats(no_docs),
        repeated_bytes.remove_repeats(no_docs),
        chosen_path.similar_documents(no_docs),
    ):
        assert df.count() == 0


def test_texts_are_shuffled_once(docs, capsys):
    """Each pass dealt all texts into blocks again."""
    repeated_bytes.remove_repeats(docs).explain()
    plan = capsys.readouterr().out
    assert "Bucketed: true" in plan
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) == 1 and "text" not in plan[plan.index("Exchange") :]


def test_orders_of_packed_numbers():
    random = np.random.default_rng(2)
    # 63 bits leave no room for the place beside the number.
    for bits in (1, 20, 40, 63):
        for n in (0, 1, 2, 1000):
            keys = random.integers(0, 1 << min(bits, 62), n).astype(np.uint64) // np.uint64(3)
            order, ascending = T.order(keys, bits)
            assert order.tolist() == np.argsort(keys, kind="stable").tolist()
            assert ascending.tolist() == sorted(keys.tolist())
            distinct, number = T.numbered(keys, bits)
            assert distinct.tolist() == sorted(set(keys.tolist())) and np.array_equal(distinct[number], keys)


def test_strings_are_sent_packed_and_without_hashes():
    """Each stretch had two hashes, which do not compress, the second of which followed from the first and the size."""
    import random

    random.seed(3)
    text = " ".join(random.choice("the of and to in is that for it was on are as with".split()) for _ in range(30_000))
    docs = pa.table({"block": pa.array([0, 0], pa.int32()), "doc_id": [1, 2], "text": [text, text[:-1]]})
    asked = pa.Table.from_batches(repeated_bytes._ask_minimizers(docs, {}, 50, 2))
    said = pa.Table.from_batches(b for k in range(2) for b in repeated_bytes._answer_minimizers(asked.slice(k, 1).combine_chunks(), 1 << 14))
    told = {"minimizers": dict(zip(said.column("slice").to_pylist(), said.column("payload").to_pylist(), strict=True))}
    sent = pa.Table.from_batches(repeated_bytes._ask_strings(docs, told, 50, 2))
    strings = sum(sent.column("n").to_pylist())
    raw = sum(len(v) for c in sent.column_names[3:] for v in sent.column(c).to_pylist())
    assert strings > 5000 and raw < 24 * strings


def test_answers_are_sent_by_runs():
    values = np.repeat(np.array([7, 3, repeated_bytes._LAST, 3]), [5, 1, 400, 2])
    raw = repeated_bytes._pack_runs(values)
    assert len(raw) == 4 * 12 and repeated_bytes._unpack_runs(raw).tolist() == values.tolist()
    assert repeated_bytes._unpack_runs(repeated_bytes._pack_runs(values[:0])).tolist() == []


def test_runs_of_bytes_against_brute_force():
    random = np.random.default_rng(8)
    at = np.array([0, 0, 90, 90, 200, 260])
    for _ in range(50):
        places = np.concatenate([np.arange(a, b - 9) for a, b in zip(at[:-1], at[1:], strict=True)])
        begin = np.sort(random.choice(places, random.integers(0, 12), replace=False))
        gone = np.zeros(260, bool)
        for b in begin:
            gone[b : b + 10] = True
        first, after = repeated_bytes._runs(begin, 10, at)
        expected_first = [i for i in range(260) if gone[i] and (i in at or not gone[i - 1])]
        expected_after = [i + 1 for i in range(260) if gone[i] and (i + 1 in at or not gone[i + 1])]
        assert first.tolist() == expected_first and after.tolist() == expected_after


def test_symbols_end_with_their_string():
    strings = [b"abcdefg", b"", b"xy", b"\x00\xff\x00", b"q"]
    at = np.cumsum([0, *map(len, strings)])
    found = bwt._symbols(np.frombuffer(b"".join(strings), np.uint8), at)
    expected = [sum((s[p + k] + 1) << 9 * (bwt.UNIT - 1 - k) for k in range(bwt.UNIT) if p + k < len(s)) for s in strings for p in range(len(s))]
    assert found.tolist() == expected


def test_only_repeated_runs_are_transformed(monkeypatch):
    """All strings that share a minimizer were, most of which share no ``length`` bytes."""
    random = np.random.default_rng(11)
    letters = lambda n: random.integers(97, 123, n, dtype=np.uint8)
    shared, twice, phrase = letters(80), letters(60), letters(16)
    texts = [np.concatenate([letters(30), phrase, letters(30)]) for _ in range(40)]
    texts += [np.concatenate([letters(9), shared, letters(9)]), shared[10:70], np.concatenate([twice, letters(5), twice])]
    doc = random.permutation(len(texts)) + 5
    at = np.cumsum([0, *map(len, texts)])
    seen, merge_all = [], bwt.merge_all
    monkeypatch.setattr(bwt, "merge_all", lambda data, *rest: seen.append(len(data)) or merge_all(data, *rest))
    least, places = repeated_bytes.least_documents(np.concatenate(texts), at, doc, 50, 300)
    raw = [x.tobytes() for x in texts]
    wanted = [min(d for d, y in zip(doc.tolist(), raw, strict=True) if x[i : i + 50] in y) for x in raw for i in range(len(x) - 49)]
    assert least.tolist() == wanted and places[-1] == len(wanted)
    assert seen == [60]
