"""MinHash near-dedup with bottom-k sketches from one hash function.

Method: a document's set of word shingles is hashed once. Its sketch is the ``SKETCH``
smallest hashes in order. Inverted lists over the retained values bring up overlaps, the
bottom of the united sketches estimates the similarity of a pair, and the pairs left are
confirmed on their whole sets.

A list is kept under a run of neighbouring values of the sketch instead of a single one, so
that a line that very many documents share doesn't bring all of them together: the longer
the sketch, the longer the run. At the least similarity linked, 0.75, neighbours in the
united sketch are shared three times in four, and the chance that two sets show no common
run is below 1e-7 (see ``RUNS``). Sets of fewer than 32 shingles use single values up to the
length that makes a shared one certain.

Equal sets are one node. Lists are compared by leaders: a round pairs a few members of each
list with all others that aren't yet in their component, then links components; a list
leaves when all of it is linked or every member outside its largest component has led. So a
group of copies costs a few comparisons per member, no list is cut short, and no link is lost.
Lists that stay open after the first rounds, as those of frequent lines do, are replaced for
their members by lists of single values, rare ones first, in which sets that are too
different to be linked hardly meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airledger.llm import hashing as H
from airledger.llm.blocks import BLOCK_BYTES, Answers, Block, BlockTable
from airledger.llm.components import stars
from airledger.llm.tables import freed_shuffles, passing, read, staged, texts
from airledger.session import Staging
from airledger.sources.files import delete_path

SHINGLE = 5
SKETCH = 128
PERCENT = 75
ESTIMATE_VALUES, LEAST_ESTIMATE = 64, 0.45
#: (run length, least and largest size of a set). Sets of 0.75 and more meet in one class.
#: With neighbours shared at 0.75, no common run is left by n values with a chance of about
#: 0.576**n for pairs (n >= 32), 0.75**n for triples (64), 0.844**n for fours (128).
RUNS = ((1, 1, 31), (2, 24, 63), (3, 48, 127), (4, 96, 1 << 62))
_ARROW = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("digest", pa.binary()),
        ("text_hash", pa.int64()),
        ("alone", pa.bool_()),
        ("runs", pa.list_(pa.int64())),
        ("members", pa.list_(pa.int64())),
    ]
)
SCHEMA = (
    "row bigint, doc_id bigint, n bigint, digest binary, text_hash bigint, "
    "alone boolean, runs array<bigint>, members array<bigint>"
)


def list_keys(members: np.ndarray) -> np.ndarray:
    """The inverted lists a sorted set of shingle hashes stands in."""
    n, found = len(members), []
    for length, least, most in RUNS:
        if least <= n <= most:
            kept = members[: n // 4 + 1] if length == 1 else members[:SKETCH]
            count = len(kept) - length + 1
            found.append(
                H.combine(*[kept[i : i + count] for i in range(length)], np.uint64(length))
            )
    return np.concatenate(found) if found else members[:0]


def _sets(block: Block):
    """For each document: its bytes' hash and its sorted set of shingle hashes."""
    data = H.ASCII_LOWER[block.data]
    starts, ends = H.words(data, block.bounds)
    sums = H.prefix_sums(H.word_hashes(data, starts, ends))
    cuts = np.searchsorted(starts, block.bounds)
    for i in range(len(block.ids)):
        lo, hi = cuts[i], cuts[i + 1]
        at = np.arange(lo, max(lo + 1, hi - SHINGLE + 1)) if hi > lo else np.arange(0)
        yield np.unique(H.spans(sums, at, np.minimum(at + SHINGLE, hi)))


def _asked(block: Block, answers: Answers) -> np.ndarray:
    found = [list_keys(members) for members in _sets(block)]
    return np.unique(np.concatenate(found))


def _rows(block: Block, answers: Answers) -> pa.Table:
    sets = list(_sets(block))
    lists = [list_keys(members) for members in sets]
    names, inverse, counts = np.unique(
        np.concatenate(lists), return_inverse=True, return_counts=True
    )
    shared = (answers.of(0, names) | (counts > 1))[inverse]
    ends = np.cumsum([len(x) for x in lists])
    rows = {name: [] for name in _ARROW.names}
    rows["row"], rows["doc_id"] = block.rows, block.ids
    bounds = block.bounds
    seen = set()
    for i, (members, keys, end) in enumerate(zip(sets, lists, ends)):
        keys = keys[shared[end - len(keys) : end]]
        sums = [np.bitwise_xor.reduce(H.mix(members + np.uint64(s)), initial=np.uint64(0)) for s in (1, 2)]
        digest = np.array([*sums, len(members)], np.uint64).tobytes()
        rows["n"].append(len(members))
        rows["digest"].append(digest)
        rows["text_hash"].append(xxhash.xxh64_intdigest(block.data[bounds[i] : bounds[i + 1]], 42))
        rows["alone"].append(len(keys) == 0)
        rows["runs"].append(np.unique(keys).view(np.int64))
        # One copy of a set per block is enough; only sets that may have a partner are kept.
        kept = len(keys) > 0 and digest not in seen
        rows["members"].append(np.sort(members.view(np.int64)) if kept else None)
        seen.add(digest)
    rows["text_hash"] = np.array(rows["text_hash"], np.uint64).view(np.int64)
    return pa.table(rows, _ARROW)


class _Rounds:
    """Tables of the rounds; what the next lists replace is deleted as soon as they are stored."""

    def __init__(self, spark: SparkSession) -> None:
        self.area = Staging(spark, "rounds")
        self.number = 0
        self.stale: list[str] = []

    def put(self, df: DataFrame, name: str, passing_by: bool = False) -> DataFrame:
        """Store ``df``; ``passing_by`` if only the next lists are made from it."""
        self.number += 1
        label = f"{name}-{self.number}"
        with freed_shuffles(self.area.spark):
            stored = self.area.put(df, label)
        if passing_by:
            self.stale.append(f"{self.area.root}/{label}")
        return stored

    def put_lists(self, lists: DataFrame) -> DataFrame:
        done, self.stale = self.stale, []
        stored = self.put(lists, "lists", passing_by=True)
        for path in done:
            delete_path(self.area.spark, path)
        return stored

    def close(self) -> None:
        delete_path(self.area.spark, self.area.root)


def _rare_first(lists: DataFrame, sets: DataFrame, rounds: _Rounds) -> DataFrame:
    """Lists under single values for the nodes of ``lists``, rare values first.

    In any order of values that all sets use, the first common value of two similar sets is
    among the first ``n // 4 + 1`` of each, and neither can share more than what follows it. So
    a member goes where too little follows for the smallest partner in the list. With rare
    values first, a copy that differs too much has spent its places on its own values.
    """
    nodes = lists.select("node", "n", "component").distinct()
    values = nodes.select("node").join(sets, "node").select("node", F.explode("members").alias("key"))
    values = rounds.put(values, "values", passing_by=True)
    often = values.groupBy("key").agg(F.count("*").alias("often"))
    places = (
        values.join(often, "key")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("often", "key"))).alias("values"))
        .select("node", F.posexplode(F.expr("slice(values, 1, size(values) div 4 + 1)")))
        .where("col.often > 1")
        .select("node", F.col("pos").alias("place"), F.col("col.key").alias("key"))
    )
    found = rounds.put(places.join(nodes, "node"), "places", passing_by=True)
    least = found.groupBy("key").agg(F.min("n").alias("least"))
    partner = F.greatest(F.col("least"), F.col("n") * PERCENT / 100)
    return (
        found.join(least, "key")
        .where((F.col("n") - F.col("place")) * 7 >= (F.col("n") + partner) * 3)
        .select("key", "node", "n", "place", "component")
    )


def _verified(pairs: DataFrame, sets: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of ``pairs (a, b, ca, cb)`` that are similar: by estimate, then by whole sets."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    bottom = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, ESTIMATE_VALUES)
    both = F.array_intersect("sa", "sb")
    likely = (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("_bottom", bottom)
        .where(F.size(F.array_intersect("_bottom", both)) >= F.size("_bottom") * LEAST_ESTIMATE)
        .select("a", "b", "ca", "cb")
    )
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    common = F.size(F.array_intersect("ma", "mb"))
    return (
        likely.join(left, "a")
        .join(right, "b")
        .withColumn("_common", common)
        .where(
            F.col("_common") * 100
            >= (F.size("ma") + F.size("mb") - F.col("_common")) * PERCENT
        )
        .select("a", "b", "ca", "cb")
    )


def _rounds():
    """``(kind of lists, share of lists, leaders per list, from the largest component)``.

    First a few lists are enough to link most of what belongs together, then members of each
    list's largest component call on those outside, which costs one comparison per outsider.
    What is still open goes on with rare values, where outsiders lead at last.
    """
    yield from (("runs", 16, 1, True), ("runs", 1, 1, True), ("runs", 1, 4, True))
    yield "values", 1, 1, True
    leaders = 16
    while True:
        yield "values", 1, leaders, False
        leaders *= 4


def _leaders(asked: DataFrame, count: int, inside: bool) -> DataFrame:
    """``(key, leader, own, size, at)``: members of each open list that call on its others.

    They are the least nodes of the list's largest component, or of those outside it. A list
    with one component left is closed and has none.
    """
    parts = asked.groupBy("key", "component").agg(
        F.count("*").alias("held"), F.min(F.struct("node", "n", "place")).alias("least")
    )
    bulk = (
        parts.groupBy("key")
        .agg(
            F.max_by(F.struct("component", "least"), "held").alias("bulk"),
            F.count("*").alias("parts"),
        )
        .where("parts > 1")
    )
    if inside and count == 1:
        first = bulk.select("key", "bulk.least.*", "bulk.component")
    else:
        order = Window.partitionBy("key").orderBy("node")
        first = (
            asked.join(bulk.select("key", F.col("bulk.component").alias("bulk")), "key")
            .where("component = bulk" if inside else "component <> bulk")
            .withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= count)
        )
    return first.select(
        "key",
        F.col("node").alias("leader"),
        F.col("component").alias("own"),
        F.col("n").alias("size"),
        F.col("place").alias("at"),
    )


def _linked(nodes: DataFrame, sets: DataFrame, sketches: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes."""
    lists = nodes.select(
        F.explode("runs").alias("key"),
        "node",
        "n",
        F.lit(0).alias("place"),
        F.col("node").alias("component"),
    )
    # Rows of one block may share a list that all others of them have left.
    often = lists.groupBy("key").count().where("count > 1").select("key")
    lists = lists.join(often, "key")
    tested, moves = None, []
    now = "runs"
    rounds = _Rounds(nodes.sparkSession)
    lists = rounds.put_lists(lists)
    for kind, share, leaders, inside in _rounds():
        if kind != now:
            lists, now = rounds.put_lists(_rare_first(lists, sets, rounds)), kind
        asked = lists.where(F.pmod(F.xxhash64("key"), F.lit(share)) == 0)
        first = rounds.put(_leaders(asked, leaders, inside), "leaders", passing_by=True)
        if first.isEmpty():
            if share > 1:
                continue
            break
        # Similar sets share three sevenths of both, and at most what follows a first common value.
        enough = "least(n - place, size - at) * 7 >= (n + size) * 3"
        alike = f"least(n, size) * 100 >= greatest(n, size) * {PERCENT}"
        pairs = (
            lists.join(first, "key")
            .where(f"component <> own and {enough} and {alike}")
            .select(
                F.greatest("node", "leader").alias("a"),
                F.least("node", "leader").alias("b"),
                F.greatest("component", "own").alias("ca"),
                F.least("component", "own").alias("cb"),
            )
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = rounds.put(pairs, "pairs")
        met = pairs.select("a", "b")
        tested = met if tested is None else tested.union(met)
        # A leader has met all of its list outside its component and needn't meet it again. A
        # list without leaders has one component, and for good.
        led = first.select("key", F.col("leader").alias("node"))
        if share == 1:
            lists = lists.join(first.select("key"), "key", "left_semi")
        lists = lists.join(led, ["key", "node"], "left_anti")
        found = rounds.put(_verified(pairs, sets, sketches), "links")
        if not found.isEmpty():
            # Components, not nodes, are linked: so later rounds have few edges.
            moves.append(stars(found.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
            lists = _moved(lists, moves[-1])
        lists = rounds.put_lists(lists)
    linked = nodes.select("node", F.col("node").alias("component"))
    for moved in moves:
        linked = _moved(linked, moved)
    linked = staged(linked, "linked")
    rounds.close()
    return linked


def _moved(rows: DataFrame, moved: DataFrame) -> DataFrame:
    """``rows`` whose ``component`` follows ``moved (node, component)``."""
    now = moved.select(F.col("node").alias("component"), F.col("component").alias("_now"))
    others = [c for c in rows.columns if c != "component"]
    return rows.join(now, "component", "left").select(
        *others, F.coalesce("_now", "component").alias("component")
    )


def near_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The component of every document under similarity 0.75 of its word shingles.

    ``docs`` has doc_id and text; other columns are ignored. Every row is a document, a null
    text is empty, and an empty set is linked with nothing. ``component_id`` is the least
    doc_id of the component (null only if it has no other). ``kept`` says that a row has that
    id. ``stays`` marks exactly one row of each component, also where ids repeat.
    ``text_hash`` is Spark's xxhash64 of the text; it tells rows with equal ids apart. An empty table gives no rows.
    """
    blocks = BlockTable(texts(docs), "minhash", block_bytes=block_bytes)
    blocks.ask(0, _asked, short=True)
    rows = staged(blocks.each(_rows, SCHEMA), "minhash")
    blocks.close()

    some = rows.where("not alone")
    classes = staged(some.groupBy("digest").agg(F.min("row").alias("row")), "classes")
    nodes = some.join(classes.select("row"), "row").select(
        F.col("row").alias("node"), "n", "runs", "members"
    )
    nodes = staged(nodes, "nodes")
    sets = nodes.select("node", "members")
    sketches = nodes.select("node", F.slice("members", 1, ESTIMATE_VALUES).alias("sketch"))
    linked = _linked(nodes, sets, sketches)

    of_class = staged(
        classes.join(linked.withColumnRenamed("node", "row"), "row", "left").select(
            "digest", F.coalesce("component", "row").alias("component")
        ),
        "classes",
    )
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    least = (
        some.groupBy("digest")
        .agg(F.min(key).alias("least"))
        .join(of_class, "digest")
        .groupBy("component")
        .agg(F.min("least").alias("least"))
    )
    answer = of_class.join(least, "component").select(
        "digest", F.col("least.doc_id").alias("_id"), F.col("least.row").alias("_row")
    )
    return rows.join(answer, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("_row").isNull(), F.col("doc_id")).otherwise(F.col("_id")).alias("component_id"),
        (F.col("_row").isNull() | F.col("doc_id").eqNullSafe(F.col("_id"))).alias("kept"),
        (F.col("_row").isNull() | (F.col("row") == F.col("_row"))).alias("stays"),
        "text_hash",
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component stays, its least doc_id's; columns unchanged.

    Rows without a word are linked with nothing, so every one of them stays. Others are told
    apart by doc_id and text; of rows that share both, any one stays.
    """

    def left(docs):
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        some = text.rlike(r"[^\x20\x09-\x0D]")
        staying = (
            near_duplicates(docs.where(some))
            .groupBy("doc_id", "text_hash")
            .agg(F.max("stays").alias("stays"), F.count("*").alias("copies"))
            .where("stays")
        )
        staying = staged(staying, "staying")
        staying = staying.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
        rows = docs.where(some).withColumn("_key", F.xxhash64(text)).join(staying, same)
        if not staying.where("copies > 1").isEmpty():
            rows = rows.dropDuplicates(["doc_id", "_key"])
        return rows.select(*docs.columns).unionByName(docs.where(~some))

    return passing(docs, left)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).drop("stays", "text_hash")
