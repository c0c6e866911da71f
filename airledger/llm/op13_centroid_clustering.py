"""Centroid clustering in whole numbers, with ns-bounds kept between rounds.

A vector counts if it has exactly ``DIMENSIONS`` components, none null or not finite. Component
x becomes ``floor(64 * x)``; distances are squared and exact, ties go to the smaller cluster.
The first centroids are the vectors with the least SHA-256 of ``1:<vec_id>``.

1. Each vector stores, for every centroid, the distance at its last evaluation and the round
   of that evaluation. The driver keeps the centroids of all rounds (16 x 64 numbers a round).
2. In a later round a stored distance is loosened by the norm of the centroid's whole
   displacement since that round, from the history, not by the sum of its moves. A vector
   stays where it is if no loosened lower bound reaches its upper bound.
3. Where one does, the vector's own distance is evaluated exactly and compared again; centroids
   that still fail are rescanned exactly, and their bounds renewed.
4. Components are summed by cluster in a hash aggregate; only sixteen rows reach the driver.
   An empty cluster keeps its centroid.

Bounds are 32-bit floats, widened by ``SLACK`` each way, so rounding can only cause a rescan;
every comparison that decides is made in 64-bit integers.

Odd rows: vectors that don't count are left out. Repeated rows are clustered one by one; equal
ids among the first centroids are ordered by their components. A null vec_id is clustered, but
comes last as a first centroid. With fewer vectors than clusters there are as many clusters as
vectors; an empty table gives an empty result. Components of 2**21 and more would not fit the
64-bit distance and fail with a message. Other columns pass through (``cluster``, ``distance``,
``cluster_inertia``, ``inertia`` and ``centroid_sha256`` are replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from airledger.llm.tables import freed_shuffles, read, ship_code
from airledger.session import Staging
from airledger.sources.files import delete_path

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LARGEST = float(1 << 21)
SLACK = 1e-6
_FAR = np.iinfo(np.int64).max
_RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
_STATE = [
    T.StructField("cluster", T.IntegerType()),
    T.StructField("distance", T.LongType()),
    T.StructField("bounds", T.ArrayType(T.FloatType())),
    T.StructField("since", T.ArrayType(T.ByteType())),
]


def whole_vectors(table: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """The vectors that count, ``embedding`` being replaced by integers ``whole``."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(
        values,
        lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * SCALE).cast("int")).otherwise(
            F.raise_error(F.lit("component too large for exact distances")).cast("int")
        ),
    )
    counted = table.where((F.size("embedding") == dimensions) & fine)
    others = [c for c in table.columns if c not in ("embedding", "whole", *_RESULTS)]
    return counted.select(*others, whole.alias("whole"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel())).cast(kind)


def _squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors.astype(np.int64) - centroid
    return (apart * apart).sum(axis=1)


def assign(
    vectors: np.ndarray,
    history: list[np.ndarray],
    cluster: np.ndarray | None = None,
    bounds: np.ndarray | None = None,
    since: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroids of ``history[-1]``, renewed bounds and their rounds, and the number of
    distances evaluated. ``history[s]`` are the centroids of round s."""
    now, centroids = len(history) - 1, history[-1]
    rows, k = len(vectors), len(centroids)
    if cluster is None:
        exact = np.stack([_squared(vectors, c) for c in centroids], axis=1)
        since = np.full((rows, k), now, np.int8)
        return exact.argmin(axis=1), np.sqrt(exact).astype(np.float32), since, rows * k
    cluster, bounds, since = cluster.copy(), bounds.copy(), since.copy()
    moved = np.stack(
        [np.sqrt(((centroids - past).astype(np.float64) ** 2).sum(axis=1)) for past in history]
    )
    loosened = moved[since, np.arange(k)]
    lower = bounds * (1 - SLACK) - loosened * (1 + SLACK)
    everyone = np.arange(rows)
    upper = (bounds * (1 + SLACK) + loosened * (1 + SLACK))[everyone, cluster]
    lower[everyone, cluster] = np.inf
    open_rows = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
    own = cluster[open_rows]
    found = np.full((len(open_rows), k), _FAR, np.int64)
    evaluated = 0
    for j in range(k):
        mine = np.flatnonzero(own == j)
        found[mine, j] = _squared(vectors[open_rows[mine]], centroids[j])
    tight = np.sqrt(found[np.arange(len(own)), own].astype(np.float64))
    bounds[open_rows, own] = tight
    since[open_rows, own] = now
    evaluated += len(own)
    failing = lower[open_rows] <= (tight * (1 + SLACK))[:, None]
    for j in range(k):
        again = np.flatnonzero(failing[:, j])
        exact = _squared(vectors[open_rows[again]], centroids[j])
        found[again, j] = exact
        bounds[open_rows[again], j] = np.sqrt(exact)
        since[open_rows[again], j] = now
        evaluated += len(again)
    cluster[open_rows] = found.argmin(axis=1)
    return cluster, bounds, since, evaluated


def _round(vectors: DataFrame, history: list[np.ndarray], dimensions: int) -> DataFrame:
    """``vectors`` with the state after assigning them to ``history[-1]``."""
    fresh = "cluster" not in vectors.columns
    others = [c for c in vectors.columns if c not in [f.name for f in _STATE]]
    schema = T.StructType([*vectors.select(*others).schema.fields, *_STATE])
    bounds_kind, since_kind = (to_arrow_type(f.dataType) for f in _STATE[2:])
    k = len(history[-1])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _matrix(batch["whole"], dimensions)
            known = () if fresh else (
                np.asarray(batch["cluster"]).astype(np.int64),
                _matrix(batch["bounds"], k),
                _matrix(batch["since"], k),
            )
            cluster, bounds, since, _ = assign(whole, history, *known)
            distance = np.empty(len(whole), np.int64)
            for j in range(k):
                mine = np.flatnonzero(cluster == j)
                distance[mine] = _squared(whole[mine], history[-1][j])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in others],
                    pa.array(cluster.astype(np.int32)),
                    pa.array(distance),
                    _lists(bounds, bounds_kind),
                    _lists(since, since_kind),
                ],
                names=schema.names,
            )

    return vectors.mapInArrow(each, schema)


def _first_centroids(vectors: DataFrame, clusters: int) -> np.ndarray:
    rank = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(rank.asc_nulls_last(), "whole").limit(clusters).select("whole")
    return np.array([row.whole for row in first.collect()], np.int64)


def _moved(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    dimensions = centroids.shape[1]
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.sum(F.col("whole")[i].cast("long")).alias(f"s{i}") for i in range(dimensions)],
    )
    after = centroids.copy()
    for row in sums.collect():
        after[row.cluster] = [row[f"s{i}"] // row.members for i in range(dimensions)]
    return after


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """``vectors`` (``vec_id``, ``whole`` and any others) with cluster, distances and digest."""
    spark = vectors.sparkSession
    ship_code(spark)
    area = Staging(spark, "clusters")
    inside = [
        c if c in ("vec_id", "whole") else f"passed{i}" for i, c in enumerate(vectors.columns)
    ]

    def put(df: DataFrame, name: str) -> DataFrame:
        with freed_shuffles(spark):
            return area.put(df, name)

    now = put(vectors.toDF(*inside), "0")
    centroids = _first_centroids(now, clusters)
    history: list[np.ndarray] = []
    for number in range(rounds + 1 if len(centroids) else 0):
        history.append(centroids)
        now = put(_round(now, history, dimensions), f"{number + 1}")
        delete_path(spark, f"{area.root}/{number}")
        if number < rounds:
            centroids = _moved(now, centroids)
    if not history:
        now = now.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in _STATE])
    summed = now.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    figures = [
        (
            row.cluster,
            row.s,
            sum(r.s for r in summed),
            hashlib.sha256(",".join(map(str, centroids[row.cluster])).encode()).hexdigest(),
        )
        for row in summed
    ]
    few = spark.createDataFrame(
        figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row per cluster.
    out = now.drop("bounds", "since").join(F.broadcast(few), "cluster")
    return out.select(*inside, *_RESULTS).toDF(*vectors.columns, *_RESULTS)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return clustered(whole_vectors(table)).select("vec_id", *_RESULTS)


def _oracle() -> str:
    steps = [
        f"""
vectors AS (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, whole) - 1 AS INTEGER) AS cluster, whole
  FROM (
    SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, whole FROM vectors
    ORDER BY h NULLS LAST, whole LIMIT {CLUSTERS}
  )
)"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""
d{r} AS (
  SELECT v.n, c.cluster, CAST(list_sum(list_transform(
           list_zip(v.whole, c.whole), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
  FROM vectors v CROSS JOIN c{r} c
),
a{r} AS (
  SELECT n, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM d{r} GROUP BY n
)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (
  SELECT cluster, list(value ORDER BY i) AS whole
  FROM (
    SELECT a.cluster, u.i, CAST(floor(sum(v.whole[u.i]) / count(*)) AS BIGINT) AS value
    FROM a{r} a JOIN vectors v USING (n) CROSS JOIN range(1, {DIMENSIONS} + 1) u(i)
    GROUP BY a.cluster, u.i
  )
  GROUP BY cluster
),
c{r + 1} AS (
  SELECT c.cluster, coalesce(m.whole, c.whole) AS whole FROM c{r} c LEFT JOIN m{r} m USING (cluster)
)""")
    return (
        "WITH"
        + ",".join(steps)
        + f"""
SELECT v.vec_id, a.cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.whole, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN vectors v USING (n) JOIN c{ROUNDS} c USING (cluster)
"""
    )


ORACLE_SQL = _oracle()
