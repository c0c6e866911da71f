"""Quality rules by host, in DataFrame functions only.

Method: rules are checked per document, failures are counted per host, and each host's failure
rate is shrunk with a beta prior that is fitted to all hosts by moments, so that hosts with
few documents stay near the mean. The verdicts are joined back: on a host beyond ``LEAST_BAD``
a document must pass every rule, elsewhere only the two base rules.

Repeated three-word windows are found inside a document's row: windows are hashed, sorted with
their places and compared with their neighbours, so words are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.llm.tables import read, staged

LEAST_BAD = 0.5
SPACE = r"[\\x20\\x09-\\x0D]"
# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Rules beside the base ones, as SQL conditions of failure.
SOFT_RULES = (
    "n_symbols * 10 > n_words",
    "n_dup_lines * 10 > n_lines * 3",
    "word_chars < n_words * 3",
    "word_chars > n_words * 12",
)


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """The counts of each text beside ``keep``; a null text has no words and one empty line."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(*keep, text.alias("_text")).select(
        *keep,
        "_text",
        F.expr(rf"filter(split(_text, '{SPACE}+'), w -> w <> '')").alias("_words"),
        F.expr(rf"filter(split(_text, '\\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("_lines"),
    )
    hashes = F.expr(
        "sort_array(slice(transform(_words, (w, i) -> struct("
        "xxhash64(w, get(_words, i + 1), get(_words, i + 2)) AS h, i AS i)),"
        " 1, greatest(0, size(_words) - 2)))"
    )
    repeated = F.expr(
        "sort_array(transform(filter(_windows, (x, i) -> coalesce(get(_windows, i - 1).h = x.h, false)"
        " OR coalesce(get(_windows, i + 1).h = x.h, false)), x -> x.i))"
    )
    covered = F.expr(
        "aggregate(transform(_at, (x, i) -> least(3, coalesce(get(_at, i + 1) - x, 3))),"
        " 0L, (a, x) -> a + x)"
    )
    return (
        words.withColumn("_windows", hashes)
        .withColumn("_at", repeated)
        .select(
            *keep,
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.translate("_text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            covered.cast("long").alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.length("_text").cast("long").alias("n_chars_all"),
        )
    )


def host_verdicts(rows: DataFrame) -> DataFrame:
    """``(host, n_docs, n_failed, failure_rate, bad_host)`` from rows with host and failed.

    The prior's mean and strength come from the mean and variance of the hosts' own rates; if
    they hardly differ, every host gets the overall mean.
    """
    hosts = rows.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("variance"))
    prior = prior.select(
        "mean",
        F.when(
            F.col("variance") > 1e-9,
            F.greatest(F.lit(1.0), F.col("mean") * (1 - F.col("mean")) / F.col("variance") - 1),
        )
        .otherwise(1e9)
        .alias("strength"),
    ).first()  # two numbers
    mean, strength = prior["mean"] or 0.0, prior["strength"]
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("failure_rate", shrunk).withColumn(
        "bad_host", F.col("failure_rate") > LEAST_BAD
    )


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts, rules and verdicts of every row of ``docs``.

    ``docs`` has doc_id, text and the column ``host``; other columns are ignored. A null text has
    no words and fails; a null host is a host of its own. Rows with equal or null ids are judged
    one by one. An empty table gives no rows. Counts are stored in the shared folder once, as
    hosts and documents both need them.
    """
    rows = measured(docs.withColumn("_host", F.coalesce(F.col(host).cast("string"), F.lit(""))), "doc_id", "_host")
    base = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    soft = F.expr(" OR ".join(f"({rule})" for rule in SOFT_RULES))
    rows = staged(
        rows.withColumnRenamed("_host", "host")
        .withColumn("base_failed", base)
        .withColumn("failed", base | soft),
        "quality-rules",
    )
    verdicts = host_verdicts(rows)
    return rows.join(verdicts, "host").withColumn(
        "kept", ~F.when(F.col("bad_host"), F.col("failed")).otherwise(F.col("base_failed"))
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT r, doc_id, host, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), p AS (
  SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3
), g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM p
), c AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY r
), m AS (
  SELECT w.r, doc_id, host, len(words)::BIGINT AS n_words,
    length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN c ON w.r = c.r
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 10 > n_words
      OR n_dup_lines * 10 > n_lines * 3 OR word_chars < n_words * 3
      OR word_chars > n_words * 12 AS failed
  FROM m
), h AS (
  SELECT host, count(*) AS n_docs, sum(failed::BIGINT)::DOUBLE AS n_failed FROM f GROUP BY host
), q AS (
  SELECT avg(n_failed / n_docs) AS mean, var_samp(n_failed / n_docs) AS variance FROM h
), s AS (
  SELECT mean, CASE WHEN variance > 1e-9 THEN greatest(1.0, mean * (1 - mean) / variance - 1)
    ELSE 1e9 END AS strength FROM q
), v AS (
  SELECT host, (n_failed + mean * strength) / (n_docs + strength) > 0.5 AS bad_host FROM h, s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (CASE WHEN bad_host THEN failed ELSE base_failed END) AS kept
FROM f JOIN v ON f.host = v.host
"""
