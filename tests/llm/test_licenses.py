from __future__ import annotations

import random
import re
import warnings

import pytest

with warnings.catch_warnings():
    warnings.simplefilter("ignore")
    import sre_parse

from railwatch.llm.license_rules import BASE, Rule, all_rules
from railwatch.llm.licenses import CONTEXT, WEIGHTS, scan_licenses, summary
from railwatch.llm.queries import QUERIES
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RULES = all_rules()


def sample(tree, rng):
    """A text that the parsed pattern matches."""
    out = ""
    for kind, value in tree:
        kind = str(kind)
        if kind == "LITERAL":
            out += chr(value)
        elif kind == "NOT_LITERAL":
            out += "x"
        elif kind == "IN":
            choices = [c for k, v in value if str(k) == "LITERAL" for c in [chr(v)]]
            choices += [chr(c) for k, v in value if str(k) == "RANGE" for c in range(v[0], v[1] + 1)]
            out += rng.choice(choices)
        elif kind == "BRANCH":
            out += sample(rng.choice(value[1]), rng)
        elif kind == "SUBPATTERN":
            out += sample(value[-1], rng)
        elif kind == "MAX_REPEAT":
            low, high, inner = value
            out += "".join(sample(inner, rng) for _ in range(rng.randint(low, min(int(high), low + 3))))
        else:
            raise ValueError(kind)
    return out


def detections(text, rules):
    """(rule, first, after, kept) of every place, by trying each rule at each word."""
    words = WORD.findall((text or "").translate(LOWER))
    joined = " ".join(words)
    at = [0]
    for w in words:
        at.append(at[-1] + len(w) + 1)
    place = {a: i for i, a in enumerate(at)}
    found = []
    for number, rule in enumerate(rules):
        pattern = re.compile(f"(?:{rule.pattern})(?![^ ])")
        for i in range(len(words)):
            if match := pattern.match(joined, at[i]):
                found.append((number, i, place[match.end() + 1]))
    out = []
    for number, first, after in found:
        mine = (rules[number].priority, -(after - first), number)
        kept = not any(
            f <= first and a >= after and (rules[n].priority, -(a - f), n) < mine for n, f, a in found
        )
        out.append((number, first, after, kept))
    return len(words), sorted(out, key=lambda d: (d[1], d[0]))


def digest(words, found, rules):
    base = [(rules[n].label, f) for n, f, _, _ in found if rules[n].base]
    kept = [rules[n] for n, _, _, k in found if k]
    labels = {r.label for r in kept} | {label for label, _ in base}
    starts = [f for _, f in base]
    score = max((WEIGHTS[r.priority - 1] for r in kept), default=0.0)
    return (
        words, len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for label, _ in base})), ",".join(sorted(labels)), score,
    )


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, rules=RULES):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, found int, row string")
    scanned = scan_licenses(df, rules)
    got = [
        (r.doc_id, r.n_words, [(d.rule, d.first, d.after, d.kept) for d in r.detections]) for r in scanned.collect()
    ]
    wanted = [(d, *detections(t, rules)) for d, t in rows]
    assert sorted(got, key=key) == sorted(wanted, key=key)
    got = [tuple(r) for r in summary(scanned).collect()]
    assert sorted(got, key=key) == sorted([(d, *digest(n, f, rules)) for d, n, f in wanted], key=key)


def texts_of_rules(seed, n):
    """Texts with samples of the rules among other words, some cut off, joined by odd separators."""
    rng = random.Random(seed)
    trees = [sre_parse.parse(r.pattern) for r in RULES]
    filler = ["mit", "der", "License", "the", "Éa", "x1", "2", "0", "cc", "by", "general", "public", "rights", "日本", "ſ", "K"]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 12)):
            words = sample(rng.choice(trees), rng).split(" ")
            if rng.random() < 0.2:
                words = words[: rng.randint(1, len(words))]
            parts += [w.upper() if rng.random() < 0.2 else w for w in words] + rng.choices(filler, k=rng.randint(0, 4))
        out.append((i, "".join(w + rng.choice([" ", " ", " ", "-", ", ", "\n", ".\x7f "]) for w in parts)))
    return out


def test_hundreds_of_rules_each_behind_its_keywords():
    rng = random.Random(3)
    assert len(RULES) >= 250
    assert {r.pattern: r.label for r in RULES if r.base} == BASE
    for rule in RULES:
        tree = sre_parse.parse(rule.pattern)
        for _ in range(60):
            text = sample(tree, rng)
            assert re.fullmatch(rule.pattern, text)
            assert any(f" {k} " in f" {text} " for k in rule.keywords), (rule, text)
            assert len(text.split(" ")) <= CONTEXT


def test_texts_made_of_rules(spark):
    check(spark, texts_of_rules(1, 150))


def test_odd_rows(spark, odd_rows):
    check(spark, [*odd_rows, (900, "CC-BY"), (901, "cc by cc by CC_BY"), (902, "all\nrights  RESERVED"), (903, "cc byé"), (904, "\x00cc\x00by")])


def test_matches_across_stretches_in_a_long_text(spark):
    """Rules at every distance from a border between stretches."""
    rng = random.Random(2)
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    text = " ".join(" ".join(["w"] * rng.randint(200, 300)) + " " + notice + " GPL-3.0-or-later" for _ in range(120))
    dense = "all rights reserved, cc by 4.0; " * 700
    check(spark, [(1, text), (2, dense), (3, "cc by")])


def test_given_documents(spark, given):
    check(spark, given)


def test_suppression_by_priority_length_and_order(spark):
    rules = [Rule("a", "x y", ("x",), 2), Rule("b", "x y z", ("x",), 2), Rule("c", "y", ("y",), 1), Rule("d", "x y z", ("z",), 2), Rule("e", "z", ("z",), 3)]
    rows = [(1, "x y z"), (2, "x y"), (3, "y z"), (4, "x x y z z")]
    check(spark, rows, rules)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: [rules[d.rule].label for d in r.detections if d.kept] for r in scan_licenses(df, rules).collect()}
    # c stands in the longer b, but counts more; d has the words of b, but comes later.
    assert kept == {1: ["b", "c"], 2: ["a", "c"], 3: ["c", "e"], 4: ["b", "c", "e"]}


def test_empty_table_and_clash(spark, no_docs):
    assert summary(scan_licenses(no_docs)).collect() == []
    assert scan_licenses(no_docs, keep=("row", "text")).columns == ["row", "text", "n_words", "detections"]
    with pytest.raises(ValueError, match="cannot be kept"):
        scan_licenses(no_docs, keep=("n_words",))


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = QUERIES["op11_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Arrow", "Python", "Pandas", "SerializeFromObject"))
