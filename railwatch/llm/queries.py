"""The dealt queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railwatch.llm import bpe, chosen_path, context_mixing, decontaminate, exact_dedup, html_text, langid, quality, repeated_bytes
from railwatch.llm import fill_in_middle, licenses, phrases, repeated_windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int):
    """Whether crc32 of doc_id as text leaves this remainder."""
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder).alias("held_out")


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row")


ORACLES["op5_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def tokenizer_path() -> str:
    """The vocabulary file of the queries; every machine has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    scored = quality.score_documents(docs, model)
    return scored.select("doc_id", held_out(5, 0), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs, ~held_out(4, 2))
    return langid.identify(docs, net).select("doc_id", held_out(4, 2), "lang_pred", "score")


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract_pages(pages, html_text.fit(pages))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_windows.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similar_documents(table(spark, sf_dir, "documents")).drop("row", "class_row")


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = context_mixing.score_documents(docs, learn=~held_out(10, 0), group=F.col("lang"))
    return scored.withColumn("held_out", held_out(10, 0))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op12_fill_in_middle"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents
), c AS (
  SELECT *, len(u)::BIGINT AS n,
    [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT FOR i IN [0, 1, 2, 3]] AS x
  FROM t
), p AS (
  SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 90
      THEN 'plain' WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM c
), s AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix
  FROM p
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM s
"""


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_phrase_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), word AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), size AS (
  SELECT lang, w, unnest(range(1, 5)) AS k FROM word
), place AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM size WHERE len(w) >= k
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM place GROUP BY ALL HAVING count(*) >= 30
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM word GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cut AS (
  SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS c FROM cand
), scored AS (
  SELECT x.lang, x.phrase, x.a, x.c, p.f AS l, q.f AS r, ((2000000::HUGEINT * x.a) // (p.f + q.f))::BIGINT AS score
  FROM cut x
  JOIN f p ON p.lang = x.lang AND p.phrase = array_to_string(x.w[1:x.c], ' ')
  JOIN f q ON q.lang = x.lang AND q.phrase = array_to_string(x.w[x.c + 1:x.k], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), part AS (
  SELECT lang, a, w, k, unnest(range(2, k)) AS m FROM cand
), inner_place AS (
  SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM part
), longer AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM inner_place GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
  WHERE g.longer IS NULL OR 100 * g.longer < 80 * b.a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
