"""Conversation prefix trie by truncation peeling.

Turns of a conversation are ordered by ``turn`` (null first); equal turns by role, then by the
SHA-256 of the text. Null roles and texts are empty. Conversation c is rebuilt: the first h
turns of conversation ``c - c % 5`` (none if absent), then its own after its first h, where h is
``crc32(decimal c) % 9``. A node is a distinct sequence of first d rebuilt turns.

Turns travel as 16-byte digests: a turn's is cut from the SHA-256 of its role and text, a node's
from the SHA-256 of its parent's and its last turn's, so equal keys are equal sequences but for
collisions of 128 bits of SHA-256. Texts are hashed where they are read and never shuffled.

Peeling goes from the deepest nodes upwards. The conversations that end at a depth join the
nodes that survive from the depth below; nodes of equal sequence are merged, which yields
everything they carry (members, children, leaves, saved bytes) at once; then the last turn is
stripped, and what remains is regrouped under the parent. It is done in two places:

1. Sequences that more than ``CROWD`` conversations start with are crowded. Below them hang
   subtrees of ``CROWD`` members at most. Each is peeled by one task from its deepest turn, as
   its rows stream in from the deepest; a single very long conversation is such a subtree, and
   only the nodes of one depth are held.
2. Crowded nodes, at most one ``CROWD``th of all turns, are peeled by Spark one depth after
   another with hash aggregates. Members are counted before any shuffle, so a first turn that a
   third of all conversations share, or a conversation copied as often, is one row per task.

The conversations that end at a crowded node are sorted by id over all tasks, written out in
pieces of text side by side, and only the pieces are digested in one stream, since a SHA-256 can
be computed in no other way.

Odd rows: rows without a conv_id are left out. Repeated rows are turns of their own. Other
columns aren't read. Without any conversation there is no node, not even a root. One
conversation's rows are ordered in one task, streaming, the text being a digest by then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airledger.llm.tables import read, ship_code, staged

CROWD = 64
FAMILY = 5
MOST_SHARED = 9
PIECE = 1 << 16
STAGED_DEPTHS = 8
ROOT = bytes(16)
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
NODE_COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]

_PATH = "conv_id bigint, depth bigint, key binary, parent binary, bytes bigint, last boolean"
_NODE = (
    "key binary, parent binary, anchor boolean, conv_id bigint, depth bigint, "
    "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, bytes of the text)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(
        F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256
    )
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.sha2(text.cast("binary"), 256).alias("text_digest"),
        F.substring(F.unhex(digest), 1, 16).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = W.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text_digest"
    )
    return slim.select("conv_id", F.row_number().over(order).alias("place"), "digest", "bytes")


def _shared(conv: str) -> F.Column:
    return F.crc32(F.col(conv).cast("string").cast("binary")) % MOST_SHARED


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations; ``place`` orders them, with gaps."""
    families = convs.select(
        F.col("conv_id").alias("c"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("conv_id"),
        _shared("conv_id").alias("shared"),
    )
    heads = (
        turns.where(F.col("place") < MOST_SHARED)
        .join(families, "conv_id")
        .where(F.col("place") <= F.col("shared"))
    )
    tails = turns.where(F.col("place") > _shared("conv_id"))
    return heads.select(F.col("c").alias("conv_id"), "place", "digest", "bytes").unionAll(
        tails.select("conv_id", "place", "digest", "bytes")
    )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes along each conversation; rows come ordered by conversation and place."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()),
            ("parent", pa.binary()), ("bytes", pa.int64()), ("last", pa.bool_()),
        ]
    )
    held = None
    for batch in batches:
        out = []
        for conv, digest, size in zip(*(batch[c].to_pylist() for c in ("conv_id", "digest", "bytes"))):
            goes_on = held is not None and held[0] == conv
            if held is not None:
                out.append((*held, not goes_on))
            depth, parent = (held[1], held[2]) if goes_on else (0, ROOT)
            key = hashlib.sha256(parent + digest).digest()[:16]
            held = (conv, depth + 1, key, parent, size)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*held, True)))], schema)


def paths(rebuilt: DataFrame) -> DataFrame:
    """One row per rebuilt turn: the node it leads to, the node before, whether it is the last."""
    ship_code(rebuilt.sparkSession)
    in_order = rebuilt.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return in_order.mapInArrow(_paths, _PATH)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Uncrowded turns, each with the first uncrowded node of its conversation."""
    conv, anchor = None, None
    for batch in batches:
        anchors = []
        for c, key in zip(batch["conv_id"].to_pylist(), batch["key"].to_pylist()):
            if c != conv:
                conv, anchor = c, key
            anchors.append(anchor)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(anchors, pa.binary())], names=[*batch.schema.names, "anchor"]
        )


def _ids_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


class _Node:
    __slots__ = ("parent", "bytes", "conv", "convs", "children", "leaves", "saved", "ends")

    def __init__(self, parent: bytes | None = None, size: int = 0) -> None:
        self.parent, self.bytes = parent, size
        self.conv: int | None = None
        self.convs = self.children = self.leaves = self.saved = 0
        self.ends: list[int] = []


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peel subtrees whose rows come by anchor, deepest first.

    Only the level being filled and the one below, whose nodes wait for their parents' least
    members, are held.
    """
    names = [c.split()[0] for c in _NODE.split(", ")]
    kinds = [
        pa.binary(), pa.binary(), pa.bool_(), *[pa.int64()] * 7, pa.string(),
    ]
    schema = pa.schema(list(zip(names, kinds)))
    anchor: bytes | None = None
    depth = 0
    level: dict[bytes, _Node] = {}
    below: dict[bytes, _Node] = {}
    out: list[dict] = []

    def finish(nodes: dict[bytes, _Node]) -> None:
        for node in nodes.values():
            node.leaves = node.leaves or 1
            node.saved += (node.convs - 1) * node.bytes

    def write(nodes: dict[bytes, _Node], at: int, parents: dict[bytes, _Node]) -> None:
        for key, node in nodes.items():
            above = parents.get(node.parent)
            row = (
                key, node.parent, above is None, node.conv, at,
                above.conv if above else None, node.convs, node.children, node.leaves,
                node.saved, _ids_digest(node.ends),
            )
            out.append(dict(zip(names, row)))

    def strip() -> None:
        """Close the level at ``depth`` and open the one above it with what survives."""
        nonlocal level, below, depth
        finish(level)
        write(below, depth + 1, level)
        above: dict[bytes, _Node] = {}
        for node in level.values():
            parent = above.setdefault(node.parent, _Node())
            parent.conv = node.conv if parent.conv is None else min(parent.conv, node.conv)
            parent.convs += node.convs
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved
        below, level, depth = level, above, depth - 1

    def close() -> None:
        # The nodes above the anchor are crowded ones, which Spark completes.
        if anchor is not None:
            finish(level)
            write(below, depth + 1, level)
            write(level, depth, {})

    for batch in batches:
        columns = ("anchor", "depth", "key", "parent", "bytes", "last", "conv_id")
        for a, d, key, parent, size, last, conv in zip(*(batch[c].to_pylist() for c in columns)):
            if a != anchor:
                close()
                anchor, depth, level, below = a, d, {}, {}
            while depth > d:
                strip()
            node = level.setdefault(key, _Node())
            node.parent, node.bytes = parent, size
            if last:
                node.ends.append(conv)
                node.convs += 1
                node.conv = conv if node.conv is None else min(node.conv, conv)
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    close()
    yield pa.RecordBatch.from_pylist(out, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered (key, conv_id) to pieces of comma-joined ids, at most ``PIECE`` bytes and one id."""
    schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("piece", pa.string())])
    key, ids, size = None, [], 0

    def row() -> dict:
        return {"key": key, "first": ids[0], "piece": ",".join(map(str, ids))}

    for batch in batches:
        out = []
        for k, conv in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
            if ids and (k != key or size >= PIECE):
                out.append(row())
                ids, size = [], 0
            key = k
            ids.append(conv)
            size += len(str(conv)) + 1
        yield pa.RecordBatch.from_pylist(out, schema)
    if ids:
        yield pa.RecordBatch.from_pylist([row()], schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered pieces to one digest per key, a piece at a time."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    key, state = None, None
    for batch in batches:
        out = []
        for k, piece in zip(batch["key"].to_pylist(), batch["piece"].to_pylist()):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    out.append({"key": key, "ends_sha256": state.hexdigest()})
                key, state = k, hashlib.sha256()
            state.update(piece.encode())
        yield pa.RecordBatch.from_pylist(out, schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": state.hexdigest()}], schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of ``ends (key, conv_id)``, however many ids a key has."""
    pieces = (
        ends.repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_pieces, "key binary, first bigint, piece string")
    )
    return (
        pieces.repartition("key")
        .sortWithinPartitions("key", "first")
        .mapInArrow(_digests, "key binary, ends_sha256 string")
    )


def _peel_crowded(crowded: DataFrame, stripped: DataFrame, deepest: int) -> DataFrame:
    """Complete the crowded nodes (key, parent, depth, bytes, conv_id, n_convs), deepest first.

    ``stripped`` holds what the subtrees peeled elsewhere leave to their parents.
    """
    done: list[DataFrame] = []
    survivors = None
    for depth in range(deepest, -1, -1):
        merged = crowded.where(F.col("depth") == depth).join(
            stripped.where(F.col("depth") == depth + 1).drop("depth"), "key", "left"
        )
        children, leaves, saved = (F.coalesce(c, F.lit(0)) for c in ("children", "leaves", "saved"))
        if survivors is not None:
            merged = merged.join(survivors, "key", "left")
            children, leaves, saved = (
                total + F.coalesce(f"more_{c}", F.lit(0))
                for total, c in ((children, "children"), (leaves, "leaves"), (saved, "saved"))
            )
        nodes = merged.select(
            "key", "parent", "depth", "conv_id", "n_convs",
            children.alias("n_children"),
            F.greatest(leaves, F.lit(1)).cast("long").alias("n_leaves"),
            (saved + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
        )
        if depth % STAGED_DEPTHS == 0:
            nodes = staged(nodes, f"crowded-{depth}")
        done.append(nodes)
        survivors = nodes.groupBy(F.col("parent").alias("key")).agg(
            F.count(F.lit(1)).alias("more_children"),
            F.sum("n_leaves").alias("more_leaves"),
            F.sum("saved_tokens").alias("more_saved"),
        )
    out = done[0]
    for nodes in done[1:]:
        out = out.unionByName(nodes)
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node, with ``NODE_COLUMNS``."""
    turns = staged(ordered_turns(conversations), "turns")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    convs = staged(convs, "conversations")
    path = staged(paths(rebuilt_turns(turns, convs)), "paths")

    # A key has one parent, depth and size; as grouping columns they keep the aggregate hashed.
    counted = path.groupBy("key", "parent", "depth", "bytes").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    root = convs.agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")
    ).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("bytes"),
        "n_convs",
        "conv_id",
    )
    crowded = staged(
        counted.where(F.col("n_convs") > CROWD).unionByName(root), "crowded"
    )
    deepest = crowded.agg(F.max("depth")).first()[0] or 0
    crowded_keys = crowded.select("key", F.lit(True).alias("is_crowded"))

    flagged = staged(path.join(crowded_keys, "key", "left"), "flagged")
    subtrees = (
        flagged.where("is_crowded IS NULL").select(*path.columns)
        .repartition("conv_id").sortWithinPartitions("conv_id", "depth")
        .mapInArrow(_anchored, _PATH + ", anchor binary")
    )
    peeled = staged(
        subtrees.repartition("anchor")
        .sortWithinPartitions("anchor", F.col("depth").desc())
        .mapInArrow(_peeled, _NODE),
        "peeled",
    )
    anchors = peeled.where("anchor")
    stripped = staged(
        anchors.groupBy(F.col("parent").alias("key"), "depth").agg(
            F.count(F.lit(1)).alias("children"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"),
        ),
        "stripped",
    )
    high = staged(_peel_crowded(crowded, stripped, deepest), "high")

    ended = flagged.where("is_crowded AND last").select("key", "conv_id")
    mute = convs.join(path.select("conv_id").distinct(), "conv_id", "left_anti")
    ended = ended.unionByName(mute.select(F.lit(ROOT).alias("key"), "conv_id"))
    least = high.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    high = high.join(least, "parent", "left").join(end_digests(ended), "key", "left")
    high = high.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)))
    low = anchors.drop("parent_conv_id").join(least, "parent").select(*NODE_COLUMNS)
    return (
        peeled.where("NOT anchor").select(*NODE_COLUMNS).unionByName(low)
        .unionByName(high.select(*NODE_COLUMNS))
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


_CRC = f"""xor(list_reduce(
    list_prepend(4294967295::BIGINT,
      list_transform(range(1, length(s) + 1), lambda i: ascii(substring(s, i, 1))::BIGINT)),
    lambda crc, b: list_reduce(
      list_prepend(xor(crc, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))
  ), 4294967295) % {MOST_SHARED}"""

ORACLE_SQL = f"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT c, c - c % {FAMILY} AS base, {_CRC} AS shared
  FROM (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s FROM conversations
        WHERE conv_id IS NOT NULL)
),
rebuilt AS (
  SELECT c, place, role, text FROM convs JOIN ordered ON conv_id = base AND place <= shared
  UNION ALL
  SELECT c, place, role, text FROM convs JOIN ordered ON conv_id = c AND place > shared
),
path AS (
  SELECT c, row_number() OVER w AS depth, strlen(text) AS bytes,
         sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER w) AS key,
         count(*) OVER (PARTITION BY c) AS turns
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT c, 0, 0, '', (SELECT count(*) FROM rebuilt r WHERE r.c = convs.c) FROM convs
),
nodes AS (
  SELECT key, any_value(depth) AS depth, any_value(bytes) AS bytes, min(c) AS conv_id,
         count(*) AS n_convs, max(turns) = any_value(depth) AS leaf,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)
                           FILTER (turns = depth), '')) AS ends_sha256
  FROM path GROUP BY key
),
summed AS (
  SELECT above.key, count(*) FILTER (n.leaf) AS n_leaves,
         count(*) FILTER (n.depth = above.depth + 1) AS n_children,
         sum((n.n_convs - 1) * n.bytes) AS saved_tokens
  FROM nodes n JOIN path above ON above.c = n.conv_id AND above.depth <= n.depth
  GROUP BY above.key
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       s.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n
JOIN summed s USING (key)
LEFT JOIN path up ON up.c = n.conv_id AND up.depth = n.depth - 1
LEFT JOIN nodes p ON p.key = up.key
"""
