"""Toxicity by cumulative-link ordinal regression on sparse text features.

Method: a document has a severity grade from 0 (clean) to ``GRADES - 1``. One weight per word
is shared by all thresholds: ``P(grade >= k) = sigmoid(w.x - t_k)`` with ``t_1 <= t_2 <= ...``.
The result is the expected grade, the sum of those probabilities. ``x`` marks the distinct
words of a text and counts how many of them begin with a stem.

Labels are 0 or 1, so the grades of toxic rows are made first: words get smoothed log-odds
from the labels, and toxic rows are cut into equal thirds by how much positive evidence they
hold. Rows are drawn by the hash of their id, ``TRAIN_ROWS`` at most; features are those
with the strongest evidence, ``FEATURES`` at most. Both bounds hold at any size, so that the
fit on the driver and the broadcast model stay as small. Scoring covers every document, as
a map without shuffle.

Odd rows: a null or empty text has no features and scores the least severity. Repeated rows
score alike; rows that share a labelled id are one training row. Words of equal evidence are
taken in their own order. A very long text costs a pass over it. An empty table gives an empty
result. Other columns pass through; those of ``FIELDS`` are replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.mapping import with_columns
from airledger.llm.tables import passing, read, staged

TRAIN_ROWS, FEATURES, LEAST_DOCS, LEAST_EVIDENCE = 20_000, 2_000, 8, 3.0
GRADES = 4
STEM = 5
LEAST_SEVERITY = 0.5
STEPS, L2 = 400, 1e-5
_WORD = re.compile(r"[^\W\d_]+")

FIELDS = [
    T.StructField("p_toxic", T.DoubleType()),
    T.StructField("expected_severity", T.DoubleType()),
    T.StructField("grade", T.IntegerType()),
    T.StructField("toxic", T.BooleanType()),
]


def features_of(text: str | None) -> list[str]:
    """The distinct words of a text, and for each longer one its stem of ``STEM`` letters.

    Stems may repeat: many forms of one stem say more than one.
    """
    words = sorted(set(_WORD.findall((text or "").lower())))
    return words + ["^" + w[:STEM] for w in words if len(w) > STEM]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """Words with weights, and the thresholds; small enough to send to every task."""

    def __init__(self, weights: dict[str, float], thresholds: list[float]) -> None:
        self.weights, self.thresholds = weights, thresholds

    def scores(self, text: str | None) -> tuple[float, float, int, bool]:
        get = self.weights.get
        x = sum([w for w in map(get, features_of(text)) if w is not None])
        above = [float(_sigmoid(np.float64(x - t))) for t in self.thresholds]
        severity = round(sum(above), 9)
        return round(above[0], 9), severity, sum(p >= 0.5 for p in above), severity >= LEAST_SEVERITY


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, n_features: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for sparse 0/1 rows, by Adam on the penalised likelihood.

    The likelihood of a grade is the difference of neighbouring cumulative probabilities.
    Thresholds are the first one and positive steps from it.
    """
    n, k = len(grades), GRADES - 1
    w, raw = np.zeros(n_features), np.array([2.0, *np.zeros(k - 1)])
    state = [np.zeros(n_features + k), np.zeros(n_features + k)]
    for step in range(1, STEPS + 1):
        gaps = np.exp(raw[1:])
        t = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        x = np.bincount(rows, w[columns], minlength=n)
        above = _sigmoid(x[:, None] - t)
        edges = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slope = np.hstack([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))])
        at = np.arange(n)
        p = np.maximum(edges[at, grades] - edges[at, grades + 1], 1e-12)
        upper, lower = slope[at, grades] / p, slope[at, grades + 1] / p
        by_x = (lower - upper) / n
        by_t = np.zeros(k + 2)
        np.add.at(by_t, grades, upper / n)
        np.add.at(by_t, grades + 1, -lower / n)
        by_t = by_t[1:-1]
        after = np.cumsum(by_t[::-1])[::-1]
        gradient = np.concatenate(
            [
                np.bincount(columns, by_x[rows], minlength=n_features) + L2 * w,
                [after[0]],
                after[1:] * gaps,
            ]
        )
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = state[0] / (1 - 0.9**step) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-9)
        w, raw = w - 0.1 * move[:n_features], raw - 0.1 * move[n_features:]
    return w, raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, label, features)`` of the labelled ids drawn, one row each.

    An id labelled twice counts as toxic; of rows that share an id, the one whose text has the
    least hash is taken.
    """
    labels = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    drawn = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(drawn), "doc_id")
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    chosen = chosen.groupBy("doc_id", "label").agg(one)
    field = T.StructField("features", T.ArrayType(T.StringType()))
    return with_columns(chosen, [field], lambda text: (features_of(text),)).drop("text")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """A model from at most ``most`` labelled ids; without toxic or clean rows, or without any word
    that tells them apart, it finds nothing."""
    rows = staged(training_rows(docs, labels, most), "toxicity")
    one = F.explode(F.array_distinct("features")).alias("word")
    total = rows.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = total["n"], total["toxic"] or 0
    if not toxic or toxic == n:
        return Model({}, [50.0] * (GRADES - 1))
    odds = F.log((F.col("hits") + 0.5) / (F.col("docs") - F.col("hits") + 0.5)) - F.lit(
        float(np.log(toxic / (n - toxic)))
    )
    spread = F.sqrt(1 / (F.col("hits") + 0.5) + 1 / (F.col("docs") - F.col("hits") + 0.5))
    evidence = (
        rows.select("label", one)
        .groupBy("word")
        .agg(F.count("*").alias("docs"), F.sum("label").alias("hits"))
        .where(F.col("docs") >= LEAST_DOCS)
        .withColumn("odds", odds)
        .withColumn("evidence", F.abs("odds") / spread)
        .where(F.col("evidence") >= LEAST_EVIDENCE)
        .orderBy(F.desc("evidence"), "word")
        .limit(FEATURES)
        .select("word", "odds")
        .collect()
    )
    if not evidence:
        return Model({}, [50.0] * (GRADES - 1))
    number = {r["word"]: i for i, r in enumerate(evidence)}
    strength = np.array([max(0.0, r["odds"]) for r in evidence])
    spark = rows.sparkSession
    # At most FEATURES rows.
    numbers = F.broadcast(spark.createDataFrame([*number.items()], "word string, number int"))
    drawn = rows.select("doc_id", "label").orderBy("doc_id").toArrow()
    # Stems count as often as a text has forms of them.
    held = rows.select("doc_id", F.explode("features").alias("word")).join(numbers, "word").orderBy("doc_id", "number")
    held = held.select("doc_id", "number").toArrow()
    marks = drawn["label"].to_numpy()
    at = np.searchsorted(drawn["doc_id"].to_numpy(), held["doc_id"].to_numpy())
    columns = held["number"].to_numpy().astype(int)
    mass = np.bincount(at, np.maximum(0, strength[columns] - 1), minlength=len(marks))
    cuts = np.quantile(mass[marks == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades = np.where(marks == 1, 1 + np.searchsorted(cuts, mass, "left"), 0)
    weights, thresholds = fit_ordinal(at, columns, grades, len(number))
    useful = {w: float(weights[i]) for w, i in number.items() if abs(weights[i]) > 1e-3}
    return Model(useful, thresholds.tolist())


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the model's columns for every row; a null text is one without words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return with_columns(docs, FIELDS, lambda text: sent.value.scores(text))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose expected severity stays below ``LEAST_SEVERITY``, columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    mark = T.StructField("_toxic", T.BooleanType())

    def left(docs):
        rows = with_columns(docs, [mark], lambda text: (sent.value.scores(text)[3],))
        return rows.where("not _toxic").drop("_toxic")

    return passing(docs, left)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return graded(docs, model).drop("text").withColumn("kept", ~F.col("toxic"))
