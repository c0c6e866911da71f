"""SimHash near-dedup: an inverted index of positional bytes with count filtering.

A text has the words ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; its shingles are three
words joined by a space, repeats included (fewer words: all of them as one; none: no shingle).
A bit of the fingerprint is 1 if it is set in over half of the shingles' XXH64 (seed 42).

1. Equal fingerprints are one entry of the index, so copies cost nothing beyond it.
2. Two fingerprints with at most 2 differing bits share at least 6 of their 8 bytes at the same
   places. Lists of single bytes would hold a 256th of the corpus each, so a list is named by
   five positional bytes at once. The places left out (three a list) are chosen so that any two
   of the eight are left out together by some list; therefore every pair that shares six bytes
   meets in a list.
3. A pair is tallied in the first list it meets in: it stays if six or more positional bytes
   agree, and is a link if 2 or fewer bits differ.
4. A list with more than ``LONG_LIST`` fingerprints isn't paired off. Its members differ in the
   24 bits left out alone; each enters the sublists named by itself and by itself with one of
   those bits flipped. Two members share a sublist exactly if 2 or fewer bits differ; all
   members of one (25 at most) are linked to its least, and pass the same tally and test.
5. Components of the links, over distinct fingerprints, give every document the least doc_id.

Odd rows: a null or empty text has the fingerprint zero and is linked like any other. Rows
that repeat are all returned. A null doc_id is kept, but never names a component; a component
of such rows alone has a null component_id. Other columns pass through, whatever their names
(``fingerprint`` and ``component_id`` are replaced). An empty table gives an empty result. Texts
are read word by word, so a very long one needs no more memory than itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.llm.components import components
from airledger.llm.lookup import looked_up
from airledger.llm.tables import read, ship_code, staged

SHINGLE = 3
SEED = 42
MOST_BITS = 2
PLACES = 8
LEAST_SHARED = PLACES - MOST_BITS
LEFT_OUT = 3
LONG_LIST = 64
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_AT_ONCE = 1 << 14


def _left_out() -> list[tuple[int, ...]]:
    """Sets of ``LEFT_OUT`` places so that any ``MOST_BITS`` places lie in one, taken greedily."""
    open_pairs = set(combinations(range(PLACES), MOST_BITS))
    chosen = []
    while open_pairs:
        best = max(
            combinations(range(PLACES), LEFT_OUT),
            key=lambda s: len(open_pairs.intersection(combinations(s, MOST_BITS))),
        )
        open_pairs.difference_update(combinations(best, MOST_BITS))
        chosen.append(best)
    return chosen


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_FREE = _left_out()
_MASKS = [
    _signed(sum(0xFF << 8 * p for p in range(PLACES) if p not in free)) for free in _FREE
]
_FLIPS = [[0] + [_signed(1 << (8 * p + b)) for p in free for b in range(8)] for free in _FREE]


def shingle_hashes(text: bytes) -> Iterator[int]:
    recent: list[bytes] = []
    count = 0
    for count, match in enumerate(_WORD.finditer(text.lower()), 1):
        recent.append(match.group())
        if count >= SHINGLE:
            yield xxhash.xxh64_intdigest(b" ".join(recent), SEED)
            del recent[0]
    if 0 < count < SHINGLE:
        yield xxhash.xxh64_intdigest(b" ".join(recent), SEED)


def fingerprint(text: bytes) -> int:
    """The fingerprint as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    total = 0
    hashes = shingle_hashes(text)
    while len(part := np.fromiter(islice(hashes, _AT_ONCE), "<u8")):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, keep_text: bool = True) -> DataFrame:
    """``docs`` with column ``simhash``; the text itself need not be kept."""
    ship_code(docs.sparkSession)
    kept = docs.drop("simhash", *([] if keep_text else ["text"]))
    schema = kept.withColumn("simhash", F.lit(0).cast("long")).schema
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py()) for text in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*kept.columns, text.alias("simhash")).mapInArrow(each, schema)


def _shared_places(differing: Column) -> Column:
    """Tally of the places whose bytes agree, from the bits that differ."""
    return reduce(
        lambda a, b: a + b,
        [
            (F.shiftrightunsigned(differing, 8 * p).bitwiseAND(F.lit(255)) == 0).cast("int")
            for p in range(PLACES)
        ],
    )


def _linked(differing: Column) -> Column:
    return (_shared_places(differing) >= LEAST_SHARED) & (F.bit_count(differing) <= MOST_BITS)


def links(prints: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join all of the distinct ``simhash`` within ``MOST_BITS`` bits."""
    lists = F.array(
        *[
            F.struct(F.lit(i).alias("part"), F.col("simhash").bitwiseAND(F.lit(m)).alias("bytes"))
            for i, m in enumerate(_MASKS)
        ]
    )
    entries = prints.select("simhash", F.inline(lists).alias("part", "bytes"))
    sizes = entries.groupBy("part", "bytes").agg(F.count(F.lit(1)).alias("size"))
    met = staged(entries.join(sizes.where("size > 1"), ["part", "bytes"]), "simhash-lists")

    short = met.where(F.col("size") <= LONG_LIST)
    one = short.select("part", "bytes", F.col("simhash").alias("a"))
    other = short.select("part", "bytes", F.col("simhash").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(
        *[F.when(differing.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(_MASKS)]
    )
    pairs = one.join(other, ["part", "bytes"]).where(
        (F.col("a") < F.col("b")) & (first == F.col("part")) & _linked(differing)
    )

    flips = F.element_at(
        F.array(*[F.array(*[F.lit(f).cast("long") for f in flip]) for flip in _FLIPS]),
        F.col("part") + 1,
    )
    flipped = met.where(F.col("size") > LONG_LIST).select(
        "part",
        F.col("simhash").alias("b"),
        F.explode(flips).alias("flip"),
    ).withColumn("near", F.col("b").bitwiseXOR(F.col("flip")))
    least = flipped.groupBy("part", "near").agg(F.min("b").alias("a"))
    starred = flipped.join(least, ["part", "near"]).where(
        (F.col("a") < F.col("b")) & _linked(differing)
    )
    return pairs.select("a", "b").unionAll(starred.select("a", "b")).distinct()


def near_copies(prints: DataFrame) -> DataFrame:
    """Rows of ``fingerprints`` with ``fingerprint`` (16 hex digits) and ``component_id``."""
    inside = [
        c if c in ("doc_id", "simhash") else f"passed{i}" for i, c in enumerate(prints.columns)
    ]
    names = [c for c in prints.columns if c not in ("simhash", "fingerprint", "component_id")]
    found = _near_copies(prints.toDF(*inside))
    found = found.toDF(*prints.columns, "_fingerprint", "_component_id")
    return found.select(
        *names,
        F.col("_fingerprint").alias("fingerprint"),
        F.col("_component_id").alias("component_id"),
    )


def _near_copies(fingerprinted: DataFrame) -> DataFrame:
    rows = staged(fingerprinted, "simhash")
    prints = staged(
        rows.groupBy("simhash").agg(
            F.min(F.col("doc_id").cast("long")).alias("least_id"),
            F.count(F.lit(1)).alias("held"),
        ),
        "simhash-distinct",
    )
    nodes = components(links(prints)).select(
        F.col("node").alias("simhash"), F.col("component").alias("class")
    )
    classed = staged(
        prints.join(nodes, "simhash", "left").withColumn(
            "class", F.coalesce("class", "simhash")
        ),
        "simhash-classes",
    )
    classes = staged(
        classed.groupBy("class").agg(
            F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("held")
        ),
        "simhash-least",
    )
    named = staged(looked_up(classed.drop("least_id"), classes, "class"), "simhash-named")
    found = looked_up(rows, named.select("simhash", "held", "component_id"), "simhash")
    shown = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select(*rows.columns, shown, "component_id")


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_copies(fingerprints(docs, keep_text=False))
