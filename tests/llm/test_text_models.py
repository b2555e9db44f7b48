from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from railwatch.llm import bpe, context_mixing, exchange, langid, quality
from railwatch.llm import text as T
from railwatch.llm.queries import QUERIES, held_out, tokenizer_path
from tests.llm import brute
from tests.llm.conftest import SF

MORE = "/root/testdata/sf0.01"


def test_tokens_and_hashes():
    texts = ["a bb\tccc", "", "  ", "ccc", None, "é bb", "x" * 300]
    data, at = T.utf8(pa.array(texts))
    first, after, row = T.tokens(data, at)
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(first, after, strict=True)] == [w for t in texts for w in brute.words(t)]
    assert row.tolist() == [i for i, t in enumerate(texts) for _ in brute.words(t)]
    h = T.span_hashes(data, first, after)
    spelled = [raw[a:b] for a, b in zip(first, after, strict=True)]
    assert all((h[i] == h[j]) == (spelled[i] == spelled[j]) for i in range(len(h)) for j in range(len(h)))


# --- BPE ---


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


ODD = ["<|endoftext|>", "a<|endoftext|> b", "<|endof", "text|>", "it's 'sand !'s ''ll", "  x \n\n y ", "a" * 700, "½ Ⅷ 12 é́", "　  z"]


def test_bpe_is_that_of_the_library(odd_docs, odd_rows, library, spark):
    from tests.llm.conftest import frame

    rows = [*odd_rows, *enumerate(ODD, 500)]
    found = bpe.encode_documents(frame(spark, rows), tokenizer_path(), full=True).collect()
    wanted = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        wanted.append((d, len(ids), tuple(ids), back, hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded, r.decoded_sha256) for r in found), key=repr) == sorted(wanted, key=repr)


def test_bpe_forms_agree():
    v = bpe.vocabulary(tokenizer_path())
    words = [w.encode() for w in ("a", "the", " international", "aaaaaaa", "ééé", " xyzzyxyzzy", "!!!!!!!!!!!!!!!!!!")]
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    for w, f, n in zip(words, np.cumsum(size) - size, size, strict=True):
        token, at = bpe.merge_many(v, data, np.array([f, f]), np.array([n, n]))
        assert token[: at[1]].tolist() == token[at[1] :].tolist() == bpe.merge_one(v, w)


def test_bpe_forgets_without_harm(library):
    enc = bpe.Encoder(bpe.vocabulary(tokenizer_path()), room=0)
    for n in range(5):
        texts = [f"some {n} words {i} <|endoftext|> of {'z' * i}" for i in range(30)]
        ids, at = enc.encode(*T.utf8(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_bpe_query(spark, given, library):
    found = {r.doc_id: r for r in QUERIES["op2_bpe_codec"](spark, SF).collect()}
    for d, t in given:
        ids = library.encode(t, add_special_tokens=False).ids
        assert found[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


# --- language and quality ---


def test_language_of_held_out_documents(spark):
    found = QUERIES["op1_language_id"](spark, MORE)
    lang = spark.read.parquet(f"{MORE}/documents.parquet").select("doc_id", "lang")
    out = found.join(lang, "doc_id").where("held_out").collect()
    assert found.count() == lang.count() and np.mean([r.lang_pred == r.lang for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_odd_rows(odd_docs, odd_rows):
    net = langid.fit(odd_docs, F.lit(True))
    out = {r.doc_id: r for r in langid.identify(odd_docs, net, keep=("doc_id",)).collect()}
    assert net.languages == ["en"] and len(out) == len({d for d, _ in odd_rows})
    assert {out[d].lang_pred for d in (15, 16, 17, 20)} == {"und"} and out[18].lang_pred == "en"


def test_network_without_labels(no_docs, docs):
    net = langid.fit(no_docs, F.lit(True))
    assert {tuple(r) for r in langid.identify(docs, net).select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_pair_tables_are_the_filters():
    random = np.random.default_rng(1)
    net = langid.Network(["a"], [random.normal(size=(k, 256, langid.FILTERS)).astype(np.float32) for k in langid.WIDTHS], np.zeros((24, 1)), np.zeros(1))
    w = random.integers(0, 256, (3, langid.WINDOW + 3)).astype(np.uint8)
    plain = np.concatenate([np.maximum(sum(f[k][w[:, k : k + langid.WINDOW]] for k in range(len(f))).max(axis=1), 0) for f in net.filters], axis=1)
    assert np.allclose(langid.responses(w, net.pair_tables()), plain, atol=1e-5)


def test_quality_of_held_out_documents(spark):
    found = QUERIES["op3_quality_classifier"](spark, MORE)
    labels = spark.read.parquet(f"{MORE}/labels.parquet")
    out = found.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in out]) > 0.93
    assert all(r.predicted == (r.score >= 0.3) for r in found.collect())


def test_quality_of_odd_rows(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(7, 1), (14, 0), (9, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    model = quality.fit(odd_docs, labels, F.lit(True))
    out = quality.score_documents(odd_docs, model).collect()
    assert len(out) == len(odd_rows) and all(0 < r.score < 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (15, 16, 17)}) <= 2
    assert quality.keep_good(odd_docs, model, 0.0).count() == len(odd_rows)


def test_training_features_are_the_whole_text():
    texts = ["some words and some more words", "", "x", "a word " * 40_000 + "the end"]
    data, at = T.utf8(pa.array(texts))
    kinds = quality.bags(data, at)
    for i, packed in enumerate(quality.pack_features(data, at)):
        ids, weight = quality.unpack_features(packed)
        some = [b[o[i] : o[i + 1]] for b, o in kinds if o[i + 1] > o[i]]
        plain: dict[int, float] = {}
        for bag in some:
            for bucket in bag.tolist():
                plain[bucket] = plain.get(bucket, 0) + 1 / len(bag) / len(some)
        assert dict(zip(ids.tolist(), weight.tolist(), strict=True)) == pytest.approx(plain, rel=1e-5)


def test_quality_learns_alike_from_any_partitions(spark):
    # Ids repeat, with the same text and with others; one text of each teaches.
    rows = [(i % 40, f"{'good' if i % 2 else 'bad'} text {i % 60} of some words") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, quality int")
    some = spark.createDataFrame(rows, "doc_id long, text string")
    models = [quality.fit(some.repartition(n), labels, F.lit(True)) for n in (1, 7)]
    assert np.array_equal(models[0].bucket_logits(), models[1].bucket_logits()) and models[0].offset == models[1].offset


def test_clashing_names_give_way(spark):
    some = spark.createDataFrame([(1, "some words", "x", 2.5)], "doc_id long, text string, lang_pred string, score double")
    keep = ("doc_id", "lang_pred", "score", "doc_id")
    assert langid.identify(some, langid.Network([], [], np.zeros(0), np.zeros(0)), keep).columns == ["doc_id", "lang_pred", "score"]
    assert quality.score_documents(some, quality.Model(), keep).first().asDict() == {"doc_id": 1, "lang_pred": "x", "score": 0.5}


def test_language_sample_has_every_window():
    text = "some words of a text " * 500
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"]), pa.array([text, "kurz"])], ["lang", "text"])
    out = pa.Table.from_batches(langid._sample_windows(iter([batch])))
    assert out.column("lang").to_pylist() == ["en"] * -(-len(text) // langid.WINDOW) + ["de"]
    whole = b"".join(w[: langid.WINDOW] for w in out.column("window").to_pylist()[:-1])
    assert whole.rstrip(b"\0").decode() == text


def test_quality_steps_against_plain_descent():
    texts = ["good words here", "bad bad bad words", "", "words", "good again, again good"] * 3
    labels = np.array([1, 0, 1, 0, 1] * 3)
    data, at = T.utf8(pa.array(texts))
    packed = quality.pack_features(data, at)
    found = quality.Model().fit(packed, labels, epochs=3, batch=4)
    plain = quality.Model()
    plain.bias[:] = np.log((np.bincount(labels) + 1) / (len(labels) + 2))
    random, done, steps = np.random.default_rng(1), 0, 3 * 4
    for _ in range(3):
        for some in np.array_split(random.permutation(len(labels)), 4):
            rate = 0.4 * (1 - done / steps)
            done += 1
            docs = [quality.unpack_features(packed[i]) for i in some]
            means = [sum((w * plain.vectors[b] for b, w in zip(*doc, strict=True)), np.zeros(quality.SIZE)) for doc in docs]
            errors = []
            for mean, label in zip(means, labels[some], strict=True):
                e = np.exp(mean @ plain.output + plain.bias)
                errors.append(e / e.sum() - np.eye(2)[label])
            back = [rate * 8 * plain.output @ error for error in errors]
            for mean, error in zip(means, errors, strict=True):
                plain.output -= rate * np.outer(mean, error)
                plain.bias -= 0.05 * rate * error
            for doc, b in zip(docs, back, strict=True):
                for bucket, w in zip(*doc, strict=True):
                    plain.vectors[bucket] -= w * b
    assert np.abs(found.output - plain.output).max() < 1e-4 and np.abs(found.output).max() > 0
    assert np.abs(found.vectors - plain.vectors).max() < 1e-4 and np.abs(found.bias - plain.bias).max() < 1e-4


def test_quality_without_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_documents(docs, quality.fit(docs, labels, F.lit(True))).collect()} == {0.5}
    assert quality.score_documents(no_docs, quality.Model()).count() == 0


def test_bucket_sums_are_the_network():
    random = np.random.default_rng(4)
    model = quality.Model()
    model.output = random.normal(size=model.output.shape).astype(np.float32)
    data, at = T.utf8(pa.array(["some words and some more words", "x", ""]))
    fast = quality.scores(data, at, model.bucket_logits(), model.offset)
    for i in range(3):
        means = [model.vectors[b[o[i] : o[i + 1]]].mean(axis=0) for b, o in quality.bags(data, at) if o[i + 1] > o[i]]
        mean = np.mean(means, axis=0) if means else np.zeros(quality.SIZE)
        z = mean @ model.output + model.bias
        assert fast[i] == pytest.approx(np.exp(z[1]) / np.exp(z).sum(), abs=1e-5)


# --- language model ---


def check_scores(found, rows):
    wanted = sorted(brute.unigram(rows), key=repr)
    found = sorted((tuple(r) for r in found.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=repr)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    assert [r[4] for r in found] == pytest.approx([r[4] for r in wanted])
    assert all(np.isfinite(r[5]) and r[5] < 0 for r in found)
    return found


def test_scores_of_given_documents(spark, given):
    check_scores(QUERIES["op4_context_mixing"](spark, SF), given)
    held = QUERIES["op4_context_mixing"](spark, MORE).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_scores_of_odd_rows(odd_docs, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    check_scores(context_mixing.score_documents(odd_docs.where("doc_id is not null"), ~held_out(10, 0), block_bytes=3000), rows)


def test_scores_without_training(docs, no_docs):
    out = context_mixing.score_documents(docs, F.lit(False)).collect()
    assert all(np.isfinite(r.score) and r.n_known == r.train_tokens == 0 for r in out)
    assert context_mixing.score_documents(no_docs, F.lit(True)).count() == 0


def test_spelling_is_a_probability():
    words = np.frombuffer(b"abc abd abe a b xyz \xc3\xa9t ", np.uint8)
    speller = context_mixing.Speller.fit(context_mixing.count_bits(words), words)
    # All bytes that can follow: each with the sum over its continuations left out, so compare first bytes alone.
    total, node_sum = 0.0, []
    for byte in range(256):
        one = np.array([byte], np.uint8) if byte == 0x20 else np.array([byte, 0x20], np.uint8)
        ends, bases = context_mixing._events(one)
        p, node = 0.0, np.ones(1, np.int64)
        for b in range(7, -1, -1):
            bit = byte >> b & 1
            inputs = np.stack([speller.stretch[k][context_mixing._slots(base[:1], node)] for k, base in enumerate(bases)])
            gate, mixed, step = speller.bits(inputs)
            odds = (mixed + speller.refined[gate, step]) / 2
            p -= np.logaddexp(0, -odds if bit else odds)[0]
            node = 2 * node + bit
        total += np.exp(p)
    assert total == pytest.approx(1)
    likely, unlikely = speller.log_probability(np.frombuffer(b"abc qqq ", np.uint8))
    assert likely > unlikely


def test_no_context_shares_the_counts_of_another():
    random = np.random.default_rng(2)
    letters = random.integers(97, 123, (60_000, 6)).astype(np.uint8)
    words = np.concatenate([letters, np.full((len(letters), 1), 0x20, np.uint8)], axis=1).ravel()
    speller = context_mixing.Speller.fit(context_mixing.count_bits(words), words[:700])
    unseen = np.frombuffer(b"QWERTYUIOPASDFGHJKLZXCVBNM ", np.uint8)
    _, bases = context_mixing._events(unseen)
    node = np.ones(len(unseen), np.int64)
    for k in range(context_mixing.ORDERS):
        found = speller.stretch[k][context_mixing._slots(bases[k], node)]
        assert not found[k + 1 :].any()


def test_weights_learn_from_all_words_of_a_slice():
    words = np.frombuffer(" ".join(f"word{i}" for i in range(30_000)).encode() + b" ", np.uint8)
    mixer = context_mixing.Mixer.new()
    assert mixer.train(context_mixing.count_bits(words), words).sum() == 8 * len(words)


def test_mixed_experts_are_a_probability():
    random = np.random.default_rng(3)
    p = random.dirichlet(np.ones(6), (3, 9))
    at = np.array([0, 4, 4, 9])
    token = random.integers(0, 6, 9)
    logs = np.log(p[:, np.arange(9), token])
    for t in range(9):
        total = 0.0
        for w in range(6):
            changed = logs.copy()
            changed[:, t] = np.log(p[:, t, w])
            total += np.exp(context_mixing.mix_experts(changed, at, np.array([0.7, 0.2, 0.1]))[t])
        assert total == pytest.approx(1)


def test_quality_sample_comes_to_the_driver_by_partition(spark, docs, monkeypatch):
    """All of it at once stood in the driver three times: as task results, as Arrow and as values."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")

    def whole(*_):
        raise AssertionError("the sample was collected whole")

    for name in ("toArrow", "collect", "toPandas"):
        monkeypatch.setattr(type(docs), name, whole)
    assert quality.fit(docs, labels, F.lit(True)).bucket_logits().any()


def test_contexts_against_brute_force():
    texts = ["a b a b c", "", "a b", "b", "a b a b c", "c c c"]
    learn = np.array([True, True, False, True, True, True])
    t = context_mixing._Tokens(pa.table({"text": texts}))
    lists = [[*x.split(), ""] for x in texts]
    steps = [[(("", *w)[i], w[i], (("", *w)[i - 1], *w[i - 1 : i]) if i else None) for i in range(len(w))] for w in lists]
    pair, triple, two = context_mixing._phrases(t)
    flat = [s for some in steps for s in some]
    assert len({*pair.tolist()}) == len({s[:2] for s in flat}) and [s[2] is not None for s in flat] == two.tolist()
    seen, came, known, times = [], [], [], []
    for mine, some in enumerate(steps):
        others = [s for i, them in enumerate(steps) if learn[i] and i != mine for s in them]
        every = [s for i, them in enumerate(steps) if learn[i] for s in them]
        for before, word, context in some:
            seen.append([sum(o[0] == before for o in others), sum(context is not None and o[2] == context for o in others)])
            came.append([sum(o[:2] == (before, word) for o in others), sum(context is not None and o[1:] == (word, context) for o in others)])
            known.append(sum(o[1] == word for o in every))
            times.append([sum(o[:2] == (before, word) for o in every), sum(context is not None and o[1:] == (word, context) for o in every)])
    found = context_mixing.foretold(t, learn, np.array(known), int(learn.sum()), np.array(times).T)
    assert found[0].T.tolist() == seen and found[1].T.tolist() == came


def test_gated_mix_is_a_probability():
    random = np.random.default_rng(4)
    p, prior = random.dirichlet(np.ones(6), (5, 9)), np.array([0.7, 0.2, 0.1])
    seen = np.array([[0, 3, 1, 0, 2, 40, 5, 0, 1], [0, 1, 0, 0, 2, 20, 0, 0, 1]])
    _, first = context_mixing.gates(seen, prior)
    assert first.sum(axis=0) == pytest.approx(1) and not first[3:, 0].any()
    logs = np.log(p[:, np.arange(9), random.integers(0, 6, 9)])
    for t in range(9):
        total = 0.0
        for w in range(6):
            changed = logs.copy()
            changed[:, t] = np.log(p[:, t, w])
            total += np.exp(context_mixing.mix_experts(changed, np.array([0, 4, 4, 9]), first)[t])
        assert total == pytest.approx(1)


def test_word_order_and_copies_tell(spark):
    """The order of the words counts, and a training document's own words do not foretell it, but those of its copy do."""
    random = np.random.default_rng(5)
    words = [f"word{i}" for i in range(60)]
    line = [" ".join(random.permutation(words)) for _ in range(40)]
    rows = [(i, x) for i, x in enumerate(line)] + [(100, line[0]), (200, line[1]), (201, " ".join(line[1].split()[::-1]))]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in context_mixing.score_documents(some, F.col("doc_id") < 200).collect()}
    assert out[200].base_score == pytest.approx(out[201].base_score)
    assert out[200].score > out[201].score + 10
    assert out[0].score == pytest.approx(out[100].score) and out[0].score > max(out[i].score for i in range(2, 40)) + 10


def test_quality_trains_in_a_task(spark, docs, monkeypatch):
    """The driver held the features of the whole sample while it trained."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")

    def here(*_):
        raise AssertionError("the driver trained")

    monkeypatch.setattr(quality.Model, "fit", here)
    assert quality.fit(docs, labels, F.lit(True)).bucket_logits().any()


def test_mixing_shuffles_texts_once(spark, docs, capsys):
    """The scoring pass dealt all texts into blocks again."""
    context_mixing.score_documents(docs, F.lit(True)).explain()
    plan = capsys.readouterr().out
    assert "Bucketed: true" in plan
    assert len([line for line in plan.splitlines() if "Exchange" in line]) == 1


def test_phrases_are_sent_packed():
    words = np.random.default_rng(1).integers(0, 100_000, 60_000)
    texts = [" ".join(f"w{x}" for x in words), None]
    docs = pa.table({"block": pa.array([0, 0], pa.int32()), "doc_id": [1, 2], "text": texts, "part": pa.array([0, None], pa.int32())})
    sent = [p for b in context_mixing._ask_words(docs, {}, 2) for p in b.column("phrases").to_pylist() if p]
    phrases = np.concatenate([exchange.unpack_ascending(p, np.uint64) for p in sent])
    assert (phrases[1:] > phrases[:-1]).all() and len(phrases) > 110_000
    assert sum(map(len, sent)) < 5.5 * len(phrases)


def test_lookups_in_order_of_the_keys():
    wanted = np.random.default_rng(2).integers(0, 50, 200).astype(np.uint64)
    keys = context_mixing._distinct(wanted[:100])
    assert (keys == np.unique(wanted[:100])).all()
    assert (context_mixing._find(keys, wanted) == np.searchsorted(keys, wanted)).all()


def test_scoring_makes_phrases_once(monkeypatch):
    """They were made three times, and sorted again for each document's own part."""
    docs = pa.table({"block": pa.array([0, 0, 0], pa.int32()), "doc_id": [1, 2, 3], "text": ["a b a", None, "b a b c"], "part": pa.array([0, 0, None], pa.int32())})
    t = context_mixing._Tokens(docs)
    pair, triple, two = context_mixing._phrases(t)
    n, m = len(np.unique(t.key)), len(np.unique(np.concatenate([pair, triple[two]])))
    spelling = np.full(n, -9, np.float32).tobytes()
    words = pickle.dumps((bytes([0]), [exchange.pack(np.full(n, 2, np.uint32))], spelling))
    told = {"words": {0: words}, "phrases": {0: exchange.pack(np.full(m, 2, np.uint32))}}
    n_tokens = np.zeros(context_mixing.GROUPS, np.int64)
    n_tokens[0] = 8

    class Shared:
        value = context_mixing.Model(context_mixing.Mixer.new(), n_tokens, n, 0)

    made, phrases = [], context_mixing._phrases
    monkeypatch.setattr(context_mixing, "_phrases", lambda t: made.append(t) or phrases(t))
    out = pa.Table.from_batches(context_mixing._score(docs, told, 1, Shared))
    assert len(made) == 1
    assert out.column("n_tokens").to_pylist() == [4, 1, 5] and all(x < 0 for x in out.column("score").to_pylist())


def test_places_by_key_and_row():
    random = np.random.default_rng(6)
    key = random.integers(0, 9, 200).astype(np.uint64) << np.uint64(60)
    row = np.sort(random.integers(0, 12, 200))
    x = context_mixing._InRows(key, row)
    known, learned = random.integers(50, 99, len(x.keys)), random.random(12) < 0.5
    pairs = list(zip(key.tolist(), row.tolist(), strict=True))
    assert x.keys.tolist() == sorted({k for k, _ in pairs})
    assert x.at_places(x.times).tolist() == [pairs.count(p) for p in pairs]
    assert x.at_places(x.before).tolist() == [pairs[:i].count(p) for i, p in enumerate(pairs)]
    of = dict(zip(x.keys.tolist(), known.tolist(), strict=True))
    assert x.of_others(known, learned).tolist() == [of[k] - learned[r] * pairs.count((k, r)) for k, r in pairs]


def test_hashes_are_ordered_without_argsort(monkeypatch):
    """64-bit keys leave no room for the place beside them, and ``argsort`` took several times as long."""
    random = np.random.default_rng(7)
    spread = random.integers(0, 1 << 63, 3000, dtype=np.uint64)
    close = random.integers(0, 50, 3000).astype(np.uint64) | np.uint64(1 << 63)
    for keys in (np.concatenate([spread, close]), spread[:1], spread[:0]):
        order, ascending = T.order(keys, 64)
        assert order.tolist() == np.argsort(keys, kind="stable").tolist() and ascending.tolist() == sorted(keys.tolist())

    def slow(*_, **__):
        raise AssertionError("keys were sorted by argsort")

    monkeypatch.setattr(np, "argsort", slow)
    T.order(spread, 64)


def test_odds_against_brute_force():
    words = np.frombuffer(b"abc abd ab b bcd abc zz ", np.uint8)
    counts = context_mixing.count_bits(words)
    for own in (False, True):
        odds = counts.odds(own)
        for i, key in enumerate(counts.keys.tolist()):
            for b in range(8):
                of = [0, 0]
                for other, n in zip(counts.keys.tolist(), counts.n.tolist(), strict=True):
                    if other >> b + 1 == key >> b + 1:
                        of[other >> b & 1] += n
                if own:
                    of[key >> b & 1] = max(of[key >> b & 1] - 1, 0)
                assert odds[i, b] == pytest.approx(np.log((of[1] + context_mixing._DELTA) / (of[0] + context_mixing._DELTA)))


def test_running_text_and_its_grams():
    texts = ["  Ab c\t\nd ", "", None, "x", " ", "abcdefg h"]
    t = context_mixing._Tokens(pa.table({"text": texts}))
    running = ["".join(w + " " for w in (x or "").lower().split()) + " " for x in texts]
    text, at = context_mixing._running(t.data, t.text_at)
    assert [text[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)] == running
    learned = np.array([True, True, False, False, True, True])
    grams, spelled = context_mixing._RunningGrams(t), {}
    for x, counts in zip(running, learned, strict=True):
        wide = " " * 5 + x
        for i in range(len(x)):
            spelled[wide[i : i + 6]] = spelled.get(wide[i : i + 6], 0) + int(counts)
    found = [int(g).to_bytes(6, "big").decode() for g in context_mixing._gathered(grams.distinct)]
    assert dict(zip(found, grams.times(learned).tolist(), strict=True)) == spelled
    assert grams.by_token(np.ones(len(found))).tolist() == [len(w) + 1 for x in running for w in x[:-1].split(" ")]


def trained(texts, learned, slices):
    """What slices have met when they train on the texts, and the running text to learn from."""
    n = len(texts)
    docs = pa.table({"block": pa.array([0] * n, pa.int32()), "doc_id": list(range(n)), "text": texts, "part": pa.array([0 if k else None for k in learned], pa.int32())})

    def by_slice(batches, work):
        rows = pa.Table.from_batches(batches)
        return [b for s in sorted(set(rows.column("slice").to_pylist())) for b in work(rows.filter(pa.compute.equal(rows.column("slice"), s)).combine_chunks())]

    sliced = by_slice(context_mixing._ask_words(docs, {}, slices), context_mixing._add_up)
    rows = pa.Table.from_batches(sliced)
    lists = rows.filter(rows.column("grams").is_valid())
    told = pa.Table.from_batches(by_slice(context_mixing._ask_contexts(lists.to_batches(), slices), context_mixing._add_contexts))
    met = 0
    for row in lists.to_pylist():
        mine = told.filter(pa.compute.equal(told.column("block"), row["slice"])).select(["payload"])
        one = pa.table({"grams": [row["grams"]], "counts": [row["counts"]], "payload": pa.array([None], pa.binary())})
        both = pa.concat_tables([one, mine], promote_options="default")
        out = next(context_mixing._train(both, pickle.dumps(context_mixing.Mixer.new()))).to_pydict()
        met += sum(n for place, n in zip(out["place"], out["n"], strict=True) if place >= context_mixing.Mixer.new().weights.size)
    text = "".join(" ".join((*(x or "").lower().split(), "", "")) if (x or "").split() else " " for x, k in zip(texts, learned, strict=True) if k)
    return met, text


@pytest.mark.parametrize("slices", [1, 3])
def test_training_meets_every_byte_of_the_running_text(slices):
    """Each distinct word was trained on once, however often it was there."""
    met, text = trained(["the cat and the dog", None, "the the the the", "unseen words", "the cat"], [True, True, True, False, True], slices)
    assert met == 8 * len(text)


def test_bits_are_foretold_across_words():
    """Contexts ended at the word."""
    random = np.random.default_rng(8)
    text = " ".join(random.choice(["ax bm", "cy dn"]) for _ in range(400)).encode() + b" "
    words = np.frombuffer(text, np.uint8)
    speller = context_mixing.Speller.fit(context_mixing.count_bits(words), words)
    after_x, after_y = (speller.log_probability(np.frombuffer(x, np.uint8))[1] for x in (b"ax bm ", b"cy bm "))
    assert after_x > after_y + 1


def test_repeated_text_weighs_as_often_as_it_is_there():
    words = np.frombuffer(b"ab ab ab ab ac ", np.uint8)
    speller = context_mixing.Speller.fit(context_mixing.count_bits(words), words)
    often, once = (speller.log_probability(np.frombuffer(b"ab " + x, np.uint8))[1] for x in (b"ab ", b"ac "))
    assert often > once
