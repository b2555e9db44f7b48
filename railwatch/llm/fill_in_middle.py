"""Fill-in-middle: texts cut into prefix, middle and suffix at places that follow from the document's id.

``regexp_count`` gives the number n of units of a text. Two hashes place the cuts, a and b units from the start, and a
pattern made for the row captures the three parts in one match: ``(unit{a})(unit{b-a})(rest)``. Every quantifier is
possessive, so the matcher runs in a loop and neither backtracks nor recurses, however long the text is.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run of ASCII letters, or any other single character.
UNIT = "[A-Za-z]++|[^A-Za-z]"


class Marks(NamedTuple):
    """What stands before the prefix, the suffix and the middle. No end of one may be the beginning of one, as a mark
    could then be found across its border with a part."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _check(marks: Marks) -> None:
    if not all(marks) or any(one != two and one in two for one in marks for two in marks) or len(set(marks)) < len(marks):
        raise ValueError("marks must differ, and none may be empty or stand in another")
    if any(two.startswith(one[i:]) for one in marks for two in marks for i in range(1, len(one))):
        raise ValueError("no end of a mark may be the beginning of one")


def hash_numbers(seed: str, ids: Column) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:id``; a missing id hashes as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in text)


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output of this form was made of."""
    p, s, m = (_quoted(mark) for mark in marks)
    psm = F.regexp_replace(output, f"(?s)^{p}(.*?){s}(.*?){m}(.*)", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{s}(.*?){p}(.*?){m}(.*)", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame,
    *,
    unit: str = UNIT,
    marks: Marks = Marks(),
    seed: str = "1",
    plain_from: int = 90,
    spm_below: int = 20,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of every row, n, form, output, prefix_chars, middle_chars and restored.

    Every text is cut whole. ``form`` is ``plain`` (output is the text, both lengths null) if the text is empty, holds
    a mark, or its third hash modulo 100 is ``plain_from`` or more; else ``spm`` (suffix, prefix, middle) if the fourth
    modulo 100 is below ``spm_below``; else ``psm``. A null text is an empty one; a missing doc_id counts as an empty id,
    so rows without one share their hashes. Repeated rows each give a row, with the same cuts; an empty table gives
    none. Other columns are ignored, but for those in ``keep``; a kept column must not have the name of a result.
    The columns are computed row by row in the JVM: no shuffle, and memory in proportion to the longest text.
    """
    _check(marks)
    results = ("n", "form", "output", "prefix_chars", "middle_chars", "restored")
    if clash := set(keep) & set(results):
        raise ValueError(f"columns of the result cannot be kept: {sorted(clash)}")
    # Names of our own, so that no kept column clashes with a step's.
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    h1, h2, h3, h4 = hash_numbers(seed, F.col("doc_id"))
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(
        row, text.alias("text"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"), F.regexp_count(text, F.lit(unit)).cast("long").alias("n")
    )
    has_mark = F.lit(False)
    for mark in marks:
        has_mark = has_mark | F.contains("text", F.lit(mark))
    plain = (F.col("n") == 0) | has_mark | (F.col("h3") % 100 >= plain_from)
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    placed = counted.select(
        "row",
        "text",
        "n",
        F.when(plain, "plain").when(F.col("h4") % 100 < spm_below, "spm").otherwise("psm").alias("form"),
        F.least(one, two).alias("a"),
        F.greatest(one, two).alias("b"),
    )
    count = "((?:" + unit + "){"
    pattern = F.concat(
        F.lit("(?s)^" + count), F.col("a"), F.lit("}+)" + count), F.col("b") - F.col("a"), F.lit("}+)(.*+)")
    )
    p, s, m = (mark.replace("\\", "\\\\").replace("$", "\\$") for mark in marks)
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    cut = placed.select("row", "n", "form", output.alias("output"))
    # Parts hold no mark, so the first of each mark is the one that was set.
    at_p, at_s, at_m = (F.locate(mark, F.col("output")) for mark in marks)
    psm, spm = F.col("form") == "psm", F.col("form") == "spm"
    prefix = F.when(psm, at_s - 1 - len(marks.prefix)).when(spm, at_m - at_p - len(marks.prefix))
    middle = F.when(psm | spm, F.length("output") - at_m - len(marks.middle) + 1)
    return cut.select(
        "row.*",
        "n",
        "form",
        "output",
        prefix.cast("long").alias("prefix_chars"),
        middle.cast("long").alias("middle_chars"),
        restored(F.col("output"), F.col("form"), marks).alias("restored"),
    )
