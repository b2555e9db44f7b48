"""License scan: ordered signature rules behind a keyword filter, with overlapping detections resolved.

Everything runs in the JVM on columns of the row itself: no Python, no shuffle, no text sent anywhere. Only texts that
hold a keyword are lower-cased and cut into stretches of words; only stretches that hold one are searched, with the rules
that the keywords in them open. A rule reports every place where it matches. A detection is suppressed if another one
covers its words and counts more: by priority, then by length, then by the order of the rules.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.llm.license_rules import Rule, all_rules

#: All that parts words, upper case still being letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words that a stretch is searched from, and context on either side. No rule matches more words than the context has.
STRETCH, CONTEXT = 256, 64
#: What a detection of each priority says about a text.
WEIGHTS = (1.0, 0.9, 0.75, 0.5)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULE = "array<struct<rule int, label string, priority int, base boolean, keywords array<string>, at string, found string>>"
DETECTION = "array<struct<rule int, label string, priority int, base boolean, first bigint, after bigint, kept boolean>>"


def _rule_table(rules: list[Rule]) -> Column:
    """The rules as a constant. ``at`` matches the empty place before a match, ``found`` captures it from there."""
    rows = []
    for number, rule in enumerate(rules):
        match = f"(?:{rule.pattern})(?![^ ])"
        rows.append(
            {
                "rule": number,
                "label": rule.label,
                "priority": rule.priority,
                "base": rule.base,
                "keywords": [f" {k} " for k in rule.keywords],
                "at": f"(?<![^ ])(?={match})",
                "found": f"(?<![^ ])(?=({match}))",
            }
        )
    return F.from_json(F.lit(json.dumps(rows)), _RULE)


def _gate(rules: list[Rule]) -> str:
    """A pattern of all keywords, in any case of A to Z, over words parted by single spaces."""
    return "(?i)(?<![^ ])(?:" + "|".join(sorted({re.escape(k) for r in rules for k in r.keywords})) + ")(?![^ ])"


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" ")))).cast("bigint")


def _each(items: Column, make) -> Column:
    return F.flatten(F.transform(items, make))


def _let(value: Column, make) -> Column:
    """``make(value)`` with the value computed once."""
    return F.transform(F.array(value), make)[0]


def _places(stretch: Column, low: Column, rule: Column) -> Column:
    """All places of one rule in a stretch whose first word is the text's word ``low``."""

    def of(pieces: Column) -> Column:
        # Each piece but the first begins at a match; the stretch begins with a space.
        def place(match: Column, i: Column) -> Column:
            ahead = F.aggregate(F.slice(pieces, 1, i + 1), F.lit(0).cast("bigint"), lambda n, p: n + _spaces(p))
            first = low + ahead - 1
            return F.struct(
                rule["rule"].alias("rule"),
                rule["label"].alias("label"),
                rule["priority"].alias("priority"),
                rule["base"].alias("base"),
                first.alias("first"),
                (first + _spaces(match) + 1).alias("after"),
            )

        return F.transform(F.regexp_extract_all(stretch, rule["found"], F.lit(1)), place)

    return _let(F.split(stretch, rule["at"], -1), of)


def _counts_more(one: Column, other: Column) -> Column:
    """Whether ``one`` covers ``other`` and counts more."""
    covers = (one["first"] <= other["first"]) & (one["after"] >= other["after"])
    longer = (one["after"] - one["first"]) > (other["after"] - other["first"])
    same_words = (one["first"] == other["first"]) & (one["after"] == other["after"])
    ahead = (one["priority"] < other["priority"]) | (
        (one["priority"] == other["priority"]) & (longer | (same_words & (one["rule"] < other["rule"])))
    )
    return covers & ahead


def _detections(text: Column, rules: list[Rule]) -> Column:
    """All detections in a text of words parted by single spaces, with whether each is kept."""
    table, gate = _rule_table(rules), F.lit(_gate(rules))

    def in_words(words: Column) -> Column:
        def stretch(start: Column) -> Column:
            low = F.greatest(start - CONTEXT, F.lit(0))
            some = F.array_join(F.slice(words, low + 1, start - low + STRETCH + CONTEXT), " ")
            return F.struct(start.cast("bigint").alias("start"), low.cast("bigint").alias("low"), F.concat(F.lit(" "), some, F.lit(" ")).alias("text"))

        def search(s: Column) -> Column:
            open_rules = F.filter(table, lambda r: F.exists(r["keywords"], lambda k: F.contains(s["text"], k)))
            found = _each(open_rules, lambda r: _places(s["text"], s["low"], r))
            own = lambda d: (d["first"] >= s["start"]) & (d["first"] < s["start"] + STRETCH)

            def judge(all_found: Column) -> Column:
                return F.transform(
                    F.filter(all_found, own),
                    lambda d: F.struct(
                        *[d[c].alias(c) for c in ("rule", "label", "priority", "base", "first", "after")],
                        (~F.exists(all_found, lambda e: _counts_more(e, d))).alias("kept"),
                    ),
                )

            return _let(found, judge)

        stretches = F.transform(F.sequence(F.lit(0), F.size(words) - 1, F.lit(STRETCH)), stretch)
        return _each(F.filter(stretches, lambda s: F.rlike(s["text"], gate)), search)

    return _let(F.split(F.translate(text, _UPPER, _LOWER), " "), in_words)


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, n_words, and ``detections``: rule, label, priority, base, first and after (words,
    from 0) and kept, ordered by place.

    Texts are searched whole, A-Z lower-cased, as words of ASCII letters, digits and all that is not ASCII. A null text
    is an empty one; a text without words or without keywords has no detections. Detections with equal words are ordered
    by their rules, of which the one that counts most is kept. Each row stands for itself, so missing and repeated ids
    change nothing; an empty table gives no rows. Other columns are ignored; a kept one must not have the name of a
    result. The work on a text is in proportion to its length, and stretches bound the pairs that are compared.
    """
    results = ("n_words", "detections")
    if clash := set(keep) & set(results):
        raise ValueError(f"columns of the result cannot be kept: {sorted(clash)}")
    rules = all_rules() if rules is None else rules
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    words = F.btrim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SEPARATORS, " "), F.lit(" "))
    texts = docs.select(row, words.alias("words"))
    none = F.array().cast(DETECTION)
    found = F.when(F.rlike("words", F.lit(_gate(rules))), _detections(F.col("words"), rules)).otherwise(none)
    counted = F.when(F.col("words") == "", F.lit(0)).otherwise(_spaces(F.col("words")) + 1)
    scanned = texts.select("row", counted.cast("bigint").alias("n_words"), found.alias("found"))
    return scanned.select("row.*", "n_words", F.when(F.size("found") > 1, ordered_by_place(F.col("found"))).otherwise(F.col("found")).alias("detections"))


def ordered_by_place(found: Column) -> Column:
    def compare(a: Column, b: Column) -> Column:
        by_place = F.sign(a["first"] - b["first"])
        return F.when(by_place != 0, by_place).otherwise(F.sign(a["rule"] - b["rule"])).cast("int")

    return F.array_sort(found, compare)


def labels_of(detections: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")


def summary(scanned: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n_words, n_base, first_word, last_word, base_labels, labels and score of scanned rows.

    ``labels`` are those kept and the base ones, ``score`` is the weight of the best detection kept, 0 without any.
    """
    base = F.filter("detections", lambda d: d["base"])
    kept = F.filter("detections", lambda d: d["kept"])
    parts = scanned.select(*[F.col(f"`{c}`") for c in (*keep, "n_words", "detections")], base.alias("_base"), kept.alias("_kept"))
    starts = F.transform("_base", lambda d: d["first"])
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.array_min(F.transform("_kept", lambda d: d["priority"])) - 1)
    return parts.select(
        *[F.col(f"`{c}`") for c in keep],
        "n_words",
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels_of(F.col("_base")).alias("base_labels"),
        labels_of(F.filter("detections", lambda d: d["kept"] | d["base"])).alias("labels"),
        F.coalesce(weight, F.lit(0.0)).alias("score"),
    )
