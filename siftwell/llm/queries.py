"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.llm.chat import format_chats
from siftwell.llm.exact_dedup import exact_groups
from siftwell.llm.fingerprint import fingerprint_edits
from siftwell.llm.frames import WORD
from siftwell.llm.mixing import mix_sources
from siftwell.llm.mixing_lm import lm_scores
from siftwell.llm.pieces import encode_texts
from siftwell.llm.quality import quality_scores
from siftwell.llm.registry import ORACLES, QUERIES, query
from siftwell.llm.runs import periodic_runs
from siftwell.llm.secrets import secret_spans
from siftwell.llm.simhash import simhash_groups
from siftwell.llm.substring_dedup import remove_repeats
from siftwell.llm.toxicity import toxicity_scores
from siftwell.llm.whitening import whitened_vectors

__all__ = ["ORACLES", "QUERIES"]


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_fingerprint")
def op1_fingerprint(spark, folder):
    return fingerprint_edits(table(spark, folder, "documents"))


@query("op2_sentencepiece")
def op2_sentencepiece(spark, folder):
    return encode_texts(table(spark, folder, "documents"))


@query("op3_simhash")
def op3_simhash(spark, folder):
    return simhash_groups(table(spark, folder, "documents"))


@query("op4_quality")
def op4_quality(spark, folder):
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op5_mixing",
    r"""WITH sizes AS (
      SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':'
          || md5(coalesce(text, ''))), 1, 13) AS BIGINT) AS bits
      FROM documents),
    weighted AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(2 * sum(size) AS DOUBLE) AS most,
        [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][
          CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
      FROM sizes GROUP BY source),
    levels AS (
      SELECT *, sum(source_size) OVER () AS total,
        (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
          - coalesce(sum(most) OVER prior, 0)) /
        (sum(weight) OVER () - coalesce(sum(weight) OVER prior, 0)) AS level
      FROM weighted WINDOW prior AS (ORDER BY most / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    targets AS (
      SELECT source, source_size, CASE WHEN total = 0 THEN 0::DOUBLE
        WHEN level * weight <= most
        THEN max(CASE WHEN level * weight <= most THEN level END) OVER () * weight
        ELSE most END AS target
      FROM levels),
    plans AS (
      SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0::DOUBLE END AS ratio
      FROM targets),
    typicals AS (
      SELECT source, CAST(floor(CAST(sum(size * size) AS DOUBLE) / greatest(sum(size), 1)) AS BIGINT) + 1
        AS typical FROM sizes GROUP BY source),
    shares AS (
      SELECT s.*, CAST(floor(CAST(size * 1000 AS DOUBLE) / (size + typical)) AS BIGINT) AS share
      FROM sizes s JOIN typicals t ON s.source IS NOT DISTINCT FROM t.source),
    means AS (
      SELECT source, CAST(sum(size * share) AS DOUBLE) / greatest(sum(size), 1) AS mean_share
      FROM shares GROUP BY source),
    chances AS (
      SELECT s.*, target, ratio, floor(ratio) AS whole, p.source_size,
        (CAST(bits AS DOUBLE) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
        CASE WHEN ratio > floor(ratio) THEN (ratio - floor(ratio)) * (1::DOUBLE
          + least(0.5::DOUBLE, 1::DOUBLE / (ratio - floor(ratio)) - 1::DOUBLE)
          * ((mean_share - share) / 1000::DOUBLE)) ELSE 0::DOUBLE END AS chance
      FROM shares s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source
      JOIN means m ON s.source IS NOT DISTINCT FROM m.source),
    places AS (
      SELECT *, CASE WHEN chance > 0 THEN
        floor(u * (1 - chance) / (u * (1 - chance) + chance * (1 - u)) * 4503599627370496::DOUBLE)
        ELSE 4503599627370495::DOUBLE END AS place
      FROM chances),
    steps AS (
      SELECT source, place, size, sum(size) AS words,
        sum(sum(size)) OVER (PARTITION BY source ORDER BY place, size) AS upto,
        any_value(target - whole * source_size) AS wanted
      FROM places GROUP BY source, place, size),
    sampled AS (
      SELECT source, place, size FROM steps
      WHERE words > 0 AND abs(upto - wanted) <= abs(upto - words - wanted))
    SELECT s.doc_id, s.size, s.source_size, s.target,
      CAST(s.size * (whole + CASE WHEN ratio > whole AND c.size IS NOT NULL
        THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM places s LEFT JOIN sampled c ON c.source IS NOT DISTINCT FROM s.source
      AND c.place = s.place AND c.size = s.size""",
)
def op5_mixing(spark, folder):
    return mix_sources(table(spark, folder, "documents"))


@query(
    "op6_exact_dedup",
    """WITH texts AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM texts WINDOW same AS (PARTITION BY text_sha256)""",
)
def op6_exact_dedup(spark, folder):
    return exact_groups(table(spark, folder, "documents"))


@query(
    "op7_substring_dedup",
    r"""WITH texts AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    places AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts WHERE len(words) > 12),
    windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS content FROM places),
    owners AS (SELECT content, min(doc_id) AS first_id FROM windows GROUP BY content HAVING count(*) > 1),
    hits AS (SELECT doc_id, i FROM windows JOIN owners USING (content) WHERE first_id < doc_id),
    gone AS (SELECT DISTINCT doc_id, i + k AS place FROM hits, range(13) AS steps(k)),
    each AS (
      SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
    kept AS (
      SELECT e.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY e.place) AS kept_text
      FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.place = e.place
      WHERE g.place IS NULL GROUP BY e.doc_id)
    SELECT t.doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed,
      sha256(coalesce(kept_text, '')) AS kept_sha256
    FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id""",
)
def op7_substring_dedup(spark, folder):
    kept = remove_repeats(table(spark, folder, "documents"))
    kept_sha256 = F.sha2("kept_text", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", kept_sha256)


@query("op8_secrets")
def op8_secrets(spark, folder):
    return secret_spans(table(spark, folder, "documents"))


@query("op9_chat_formatting")
def op9_chat_formatting(spark, folder):
    return format_chats(table(spark, folder, "conversations"))


@query("op10_lm_scoring")
def op10_lm_scoring(spark, folder):
    return lm_scores(table(spark, folder, "documents"))


def with_planted_runs(docs):
    """``doc_id, text``; about a tenth of the texts, by CRC-32 of the identifier, turn periodic.

    From word ``a`` on, word ``i`` becomes the original word ``a + (i - a) % p``.
    """
    check = F.crc32(docs["doc_id"].cast("string").cast("binary"))
    words, n, a, p = F.col("words"), F.size("words"), F.col("a"), F.col("p")
    g = F.floor(F.col("check") / 10)
    planted = docs.select(
        "doc_id",
        F.coalesce(docs["text"], F.lit("")).alias("text"),
        check.alias("check"),
        F.when(check % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))).alias("words"),
    )
    planted = planted.withColumn("a", F.pmod(g, F.greatest(n, F.lit(1))).cast("int"))
    planted = planted.withColumn("p", 1 + F.floor((n - a) / (3 + g % 8)).cast("int"))
    again = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
    rewritten = F.array_join(F.concat(F.slice("words", 1, a), again), " ")
    return planted.select("doc_id", F.when(n > 0, rewritten).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, folder):
    found = periodic_runs(with_planted_runs(table(spark, folder, "documents")))
    best = lambda r: F.struct((-r["length"]).alias("least"), r["start"], r["period"], r["length"])
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", F.array_min(F.transform("runs", best))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


@query("op12_toxicity")
def op12_toxicity(spark, folder):
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_whitening")
def op13_whitening(spark, folder):
    return whitened_vectors(table(spark, folder, "embeddings"))
