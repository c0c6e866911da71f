"""Blocks of documents that ask all other blocks which of their keys they also hold.

A block is one row with some megabytes of whole documents. ``BlockTable`` stores blocks in a
table bucketed by block, so later passes join small answers to them without moving a text
again. A question goes like this: every block turns what it wants to know into 64-bit keys,
keeps one copy of each (a key that fills a third of all rows leaves a block once), packs
them per bucket of the key space and sends the packs; a bucket sorts its keys and answers
with one bit per key. Blocks compute their keys again in the next pass and read the bits by
position, so no key travels back.

Memory: a block (``BLOCK_BYTES``, or one longer document) and its keys, or one bucket's keys.
The number of buckets follows ``spark.sql.shuffle.partitions``, which a cluster sets with
its data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.llm.tables import freed_shuffles, ship_code
from airledger.session import fresh_folder
from airledger.sources.files import delete_path

BLOCK_BYTES = 8 << 20
BLOCK_SCHEMA = "block bigint, ids array<bigint>, sizes array<bigint>, data binary"
PACK_SCHEMA = "bucket int, block bigint, keys binary"
ANSWER_SCHEMA = "block bigint, level int, bucket int, bits binary, later binary"


def _pack(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("ids", pa.list_(pa.int64())),
            ("sizes", pa.list_(pa.int64())),
            ("data", pa.binary()),
        ]
    )
    block = TaskContext.get().partitionId() << 20
    ids: list[int | None] = []
    parts: list[bytes] = []

    def row():
        sizes = [len(p) for p in parts]
        return pa.RecordBatch.from_pylist(
            [{"block": block, "ids": ids, "sizes": sizes, "data": b"".join(parts)}], schema
        )

    size = 0
    for batch in batches:
        for doc_id, text in zip(batch[0].to_pylist(), batch[1].cast(pa.binary()).to_pylist()):
            ids.append(doc_id)
            parts.append(text)
            size += len(text) + 64  # so that empty texts fill a block, too
            if size >= block_bytes:
                yield row()
                block, ids, parts, size = block + 1, [], [], 0
    if ids:
        yield row()


class Block:
    """One block inside a task: its documents' ids, its bytes and where documents begin."""

    def __init__(self, table: pa.Table) -> None:
        self.number = table["block"][0].as_py()
        self.ids = table["ids"][0].as_py()
        #: Ids of the rows, unique in the whole table; a block has fewer than a million rows.
        self.rows = (self.number << 20) + np.arange(len(self.ids))
        data = table["data"][0].as_buffer()  # a view, not a copy
        self.data = np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)
        self.bounds = np.zeros(len(self.ids) + 1, np.int64)
        np.cumsum(table["sizes"][0].values.to_numpy(), out=self.bounds[1:])


class Answers:
    """The bits other buckets gave this block, by level."""

    def __init__(self, table: pa.Table | None, buckets: int) -> None:
        self.buckets = buckets
        self.bits: dict[tuple[int, int], np.ndarray] = {}
        if table is not None:
            for level, bucket, bits, later in zip(
                table["level"].to_pylist(),
                table["bucket"].to_pylist(),
                table["bits"],
                table["later"],
            ):
                self.bits[level, bucket] = np.frombuffer(bits.as_buffer(), np.uint8)
                if later.is_valid:
                    self.bits[~level, bucket] = np.frombuffer(later.as_buffer(), np.uint8)

    def of(self, level: int, keys: np.ndarray) -> np.ndarray:
        """For sorted distinct 64-bit keys as they were asked: is another holder known?

        Level ``~k`` of a question ``k`` asked with ``order`` tells of earlier blocks only.
        """
        out = np.zeros(len(keys), bool)
        for bucket, lo, hi in _slices(keys, self.buckets):
            bits = self.bits.get((level, bucket))
            if bits is not None:
                out[lo:hi] = np.unpackbits(bits, count=hi - lo).view(bool)
        return out


def _slices(keys: np.ndarray, buckets: int):
    """The ranges of sorted keys that belong to each bucket; ``buckets`` is a power of two."""
    shift = 64 - (buckets.bit_length() - 1)
    if shift == 64:
        cuts = np.array([0, len(keys)])
    else:
        marks = np.arange(buckets, dtype=np.uint64) << np.uint64(shift)
        cuts = np.append(np.searchsorted(keys, marks), len(keys))
    for bucket in range(buckets):
        if cuts[bucket] < cuts[bucket + 1]:
            yield bucket, cuts[bucket], cuts[bucket + 1]


def _pack_keys(block: int, keys: np.ndarray, buckets: int, short: bool) -> pa.Table:
    """Short keys keep the 32 bits below the bucket's own: enough for a filter, not a proof."""
    rows = {"bucket": [], "block": [], "keys": []}
    drop = np.uint64(32 - (buckets.bit_length() - 1))
    for bucket, lo, hi in _slices(keys, buckets):
        part = keys[lo:hi]
        rows["bucket"].append(bucket)
        rows["block"].append(block)
        rows["keys"].append(((part >> drop).astype(np.uint32) if short else part).tobytes())
    return pa.table(
        rows, pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary())])
    )


def _answer(level: int, short: bool, order: bool) -> Callable[[pa.Table], pa.Table]:
    kind = np.uint32 if short else np.uint64

    def answer(table: pa.Table) -> pa.Table:
        blocks = table["block"].to_numpy()
        packs = [np.frombuffer(k.as_buffer(), kind) for k in table["keys"]]
        along = np.argsort(blocks, kind="stable")
        sizes = np.array([len(packs[i]) for i in along])
        keys = np.concatenate([packs[i] for i in along])
        del packs
        at = np.argsort(keys, kind="stable")
        equal = keys[at[1:]] == keys[at[:-1]]
        later = np.zeros(len(keys), bool)
        later[at[1:][equal]] = True
        shared = later.copy()
        shared[at[:-1][equal]] = True
        rows = {"block": [], "level": [], "bucket": [], "bits": [], "later": []}
        bucket = table["bucket"][0].as_py()
        for i, end, size in zip(along, np.cumsum(sizes), sizes):
            bits = shared[end - size : end]
            if bits.any():
                rows["block"].append(blocks[i])
                rows["level"].append(level)
                rows["bucket"].append(bucket)
                rows["bits"].append(np.packbits(bits).tobytes())
                rows["later"].append(
                    np.packbits(later[end - size : end]).tobytes() if order else None
                )
        return pa.table(
            rows,
            pa.schema(
                [
                    ("block", pa.int64()),
                    ("level", pa.int32()),
                    ("bucket", pa.int32()),
                    ("bits", pa.binary()),
                    ("later", pa.binary()),
                ]
            ),
        )

    return answer


class BlockTable:
    """Documents as blocks, and the answers the blocks have got so far.

    Blocks are numbered in the order of their rows; with ``ordered`` that is the order of
    doc_id (nulls first), equal ids by the hash of their text, then by place in the input.
    """

    def __init__(
        self, docs: DataFrame, label: str, ordered: bool = False, block_bytes: int = BLOCK_BYTES
    ) -> None:
        self.spark: SparkSession = docs.sparkSession
        ship_code(self.spark)
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = 1 << max(6, (partitions - 1).bit_length())
        self.root = fresh_folder(self.spark, label)
        self.name = f"blocks_{uuid.uuid4().hex}"
        rows = docs.select("doc_id", "text")
        if ordered:
            rows = (
                rows.withColumn("_text", F.xxhash64("text"))
                .withColumn("_row", F.monotonically_increasing_id())
                .repartitionByRange("doc_id", "_text", "_row")
                .sortWithinPartitions("doc_id", "_text", "_row")
                .select("doc_id", "text")
            )
        rows.mapInArrow(lambda batches: _pack(batches, block_bytes), BLOCK_SCHEMA).write.bucketBy(partitions, "block").option(
            "path", f"{self.root}/blocks"
        ).option("compression", "zstd").option("parquet.block.size.row.check.min", 1).saveAsTable(
            self.name
        )
        self.answers: DataFrame | None = None

    def each(self, work: Callable[[Block, Answers], pa.Table], schema: str) -> DataFrame:
        """``work`` on every block with its answers."""
        table, buckets = self.spark.table(self.name), self.buckets
        if self.answers is None:
            return table.groupBy("block").applyInArrow(
                lambda rows: work(Block(rows), Answers(None, buckets)), schema
            )

        def both(rows: pa.Table, answers: pa.Table) -> pa.Table:
            return work(Block(rows), Answers(answers, buckets))

        return (
            table.groupBy("block")
            .cogroup(self.answers.groupBy("block"))
            .applyInArrow(both, schema)
        )

    def ask(
        self,
        level: int,
        keys: Callable[[Block, Answers], np.ndarray],
        short: bool = False,
        order: bool = False,
    ) -> None:
        """Ask about the sorted distinct keys of every block.

        ``short`` sends half of each key: other keys may then be taken for it, so the answer
        can only serve as a filter. ``order`` also tells whether an earlier block holds it.
        """
        buckets = self.buckets
        packs = self.each(
            lambda block, answers: _pack_keys(block.number, keys(block, answers), buckets, short),
            PACK_SCHEMA,
        )
        path = f"{self.root}/answers-{level}"
        answers = packs.groupBy("bucket").applyInArrow(_answer(level, short, order), ANSWER_SCHEMA)
        with freed_shuffles(self.spark):
            answers.write.option("compression", "zstd").parquet(path)
        got = self.spark.read.schema(ANSWER_SCHEMA).parquet(path)
        self.answers = got if self.answers is None else self.answers.unionByName(got)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.root)
