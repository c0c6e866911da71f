"""Quality classifier by hierarchical empirical Bayes.

Method: a logistic model on shape measures of a text gives each document's evidence. Evidence
is summed per host and per path (a section of a host; documents carry the host in ``source``
and the section in ``lang``). A host's share of good documents is shrunk to the global share,
a path's share to its host's, each with a strength fitted by moments, so that sparse sites
lean on what stands above them. A document's log-odds are its own plus those of its path,
less the global ones.

Rows are drawn for the fit by the hash of their id, ``TRAIN_ROWS`` at most at any size; sums
cover all documents. Text measures are DataFrame functions, stored once; groups are summed
before they are shuffled, and no text is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.llm.op9_quality_rules import measured
from airledger.llm.tables import read, staged

TRAIN_ROWS = 20_000
MEASURES = {
    "size": "ln(1 + n_words)",
    "symbols": "n_symbols / (1 + n_words)",
    "lines": "n_dup_lines / (1 + n_lines)",
    "repeats": "n_repeat_words / (1 + n_words)",
    "width": "word_chars / (1 + n_words)",
    "capitals": "n_capitals / (1 + word_chars)",
    "marks": "n_marks / (1 + n_words)",
}
#: Evidence is kept away from certainty, so that a site can still be outweighed.
MOST = 6.0


def shapes(docs: DataFrame, *keep: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    marks = F.length(text) - F.length(F.translate(text, "!?:;=", ""))
    counted = docs.withColumn("_capitals", capitals).withColumn("_marks", marks)
    counted = measured(counted, *keep, "_capitals", "_marks").withColumnsRenamed(
        {"_capitals": "n_capitals", "_marks": "n_marks"}
    )
    return counted.select(*keep, *[F.expr(sql).alias(name) for name, sql in MEASURES.items()])


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Weights and a constant by Newton's steps; ``l2`` keeps separable data finite."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 0.5 * (1 + np.tanh(0.5 * (x @ w)))
        slope = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence(rows: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Column:
    """The log-odds of being good as an expression of the measures."""
    labels = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # Of rows that share an id the one with the least measures counts, so a drawn id is one row.
    least = F.min(F.struct("label", *MEASURES)).alias("least")
    drawn = rows.join(F.broadcast(labels), "doc_id").groupBy("doc_id").agg(least)
    sample = drawn.orderBy("doc_id").select("least.*").toArrow()
    y = sample["label"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return F.lit(MOST if not len(y) or y[0] else -MOST)
    x = np.stack([sample[name].to_numpy() for name in MEASURES], axis=1)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = fit_logistic((x - centre) / scale, y)
    odds = F.lit(float(w[-1]))
    for name, weight, c, s in zip(MEASURES, w, centre, scale):
        odds = odds + (F.col(name) - float(c)) / float(s) * float(weight)
    return F.greatest(F.lit(-MOST), F.least(F.lit(MOST), odds))


def _strength(groups: DataFrame, share: Column, above: Column) -> float:
    """How many documents the level above is worth: from the spread of the groups around it."""
    spread = groups.agg(
        F.avg((share - above) ** 2).alias("v"), F.avg(above * (1 - above)).alias("m"), F.avg(1 / F.col("n")).alias("i")
    ).first()
    noise = (spread["m"] or 0.0) * (spread["i"] or 0.0)
    between = max((spread["v"] or 0.0) - noise, 1e-6)
    return min(1e6, max(1.0, (spread["m"] or 0.0) / between - 1))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def scored(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang"
) -> DataFrame:
    """``doc_id, evidence, host_share, path_share, score, kept`` of every row of ``docs``.

    Other columns are ignored. A null text is empty, a null host or path is one of its own, and
    rows with equal or null ids are scored one by one. Labels that disagree count as bad. With
    labels of one class, or none, all evidence is for that class, or for good. An empty table
    gives no rows.
    """
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
    )
    rows = staged(shapes(named, "doc_id", "host", "path"), "shapes")
    rows = rows.withColumn("evidence", evidence(rows, labels))
    good = 1 / (1 + F.exp(-F.col("evidence")))
    paths = staged(
        rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(good).alias("good")),
        "paths",
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = (total["good"] + 1.0) / (total["n"] + 2.0) if total["n"] else 0.5
    k = _strength(hosts, F.col("good") / F.col("n"), F.lit(share))
    hosts = hosts.select(
        "host", ((F.col("good") + k * share) / (F.col("n") + k)).alias("host_share")
    )
    paths = staged(paths.join(hosts, "host"), "paths")
    k = _strength(paths, F.col("good") / F.col("n"), F.col("host_share"))
    paths = paths.select(
        "host",
        "path",
        "host_share",
        ((F.col("good") + k * F.col("host_share")) / (F.col("n") + k)).alias("path_share"),
    )
    odds = F.col("evidence") + _odds(F.col("path_share")) - F.lit(float(np.log(share / (1 - share))))
    return rows.join(paths, ["host", "path"]).select(
        "doc_id",
        "evidence",
        "host_share",
        "path_share",
        (1 / (1 + F.exp(-odds))).alias("score"),
        (odds >= 0).alias("kept"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores are rounded: sums of doubles depend on the order of rows in their last digits."""
    found = scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    numbers = ("evidence", "host_share", "path_share", "score")
    return found.withColumns({c: F.round(c, 6) for c in numbers})
