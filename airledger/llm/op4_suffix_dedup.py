"""Suffix-array dedup: remove bytes covered by a repeated string of a fixed length.

Method: blockwise suffix construction with a difference cover. Of the positions of a
document only those whose offset modulo ``v`` lies in a difference cover are sampled: any two
offsets have a common shift below ``v`` that brings both onto sampled positions, so two
equal strings of ``length`` bytes show two equal samples of ``length - v + 1`` bytes.

1. Sample suffixes are ranked to that depth: buckets of the key space are sorted one at a
   time (one task each), and a sample whose name is unique drops out.
2. Surviving samples are ranked again to depth ``length + v - 1``. A tie at that depth
   settles all ``v`` starts from the sample on, which are the long ties that would cost
   most; only the first holder of such a name keeps them as candidates for others.
3. The remaining candidate starts are sorted by their whole string, bucket by bucket.

Buckets are cut from 64-bit fingerprints instead of leading bytes: only equality is asked
for, and fingerprints keep the buckets even on any text. Names of steps 2 and 3 are 64-bit
fingerprints with values drawn by a rule; they stand for the strings.

A task holds one block of documents or one bucket of keys. Equal keys leave a block once, so
a string that fills a third of the input is sent once per block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from airledger.llm import hashing as H
from airledger.llm.blocks import BLOCK_BYTES, Answers, Block, BlockTable
from airledger.llm.tables import read, staged, texts

LENGTH = 400
SCHEMA = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
    "spans array<struct<start: bigint, end: bigint>>"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
DEEP, STARTS = 1, 2


def difference_cover(q: int) -> tuple[int, np.ndarray]:
    """A perfect difference set modulo ``q*q + q + 1`` for a prime ``q``, by Singer's rule.

    The powers of a root of a primitive cubic over the field of ``q`` elements that lie in a
    plane form the set; the cubic is found by trying.
    """
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, found = (1, 0, 0), []
                for i in range(v):
                    if x[2] == 0:
                        found.append(i)
                    x = ((c * x[2]) % q, (x[0] + b * x[2]) % q, (x[1] + a * x[2]) % q)
                gaps = {(m - n) % v for m in found for n in found}
                if len(found) == q + 1 and len(gaps) == v:
                    return v, np.array(found)
    raise ValueError(f"{q} is not a prime")


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The largest cover that leaves samples of at least a fifth of ``length``."""
    best = (1, np.array([0]))
    for q in range(2, 100):
        if all(q % d for d in range(2, q)) and q * q + q + 1 <= 0.8 * length:
            best = difference_cover(q)
        elif q * q > length:
            break
    return best


class _Cover:
    def __init__(self, length: int) -> None:
        self.length = length
        self.v, members = cover_for(length)
        self.depth = length - self.v + 1
        self.member = np.zeros(self.v, bool)
        self.member[members] = True

    def samples(self, block: Block) -> np.ndarray:
        found = []
        for begin, end in zip(block.bounds[:-1], block.bounds[1:]):
            if end - begin >= self.depth:
                tiles = -(-(end - begin) // self.v)
                at = np.flatnonzero(self.member)
                at = (at + (np.arange(tiles) * self.v)[:, None]).ravel()
                found.append(begin + at[at + self.depth <= end - begin])
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def surviving(self, block: Block, answers: Answers) -> np.ndarray:
        at = self.samples(block)
        keys = H.window_hashes(block.data, at, self.depth)
        return at[_shared(answers, 0, keys)]

    def deep(self, block: Block, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = self.length + self.v - 1
        at = at[at + width <= _ends(block, at)]
        return at, H.window_hashes(block.data, at, width)

    def candidates(self, block: Block, answers: Answers) -> tuple[np.ndarray, np.ndarray]:
        """Starts to ask about, and a mask of starts that are known to repeat."""
        n = len(block.data)
        at = self.surviving(block, answers)
        ends = _ends(block, at)
        begins = block.bounds[np.searchsorted(block.bounds, at, "right") - 1]
        first = np.maximum(begins, at - self.v + 1)
        last = np.minimum(at, ends - self.length)
        open_ = _cover(n, first, last + 1)
        at, keys = self.deep(block, at)
        names, index, inverse, counts = np.unique(
            keys, return_index=True, return_inverse=True, return_counts=True
        )
        tied = answers.of(DEEP, names) | (counts > 1)
        # One occurrence speaks for a name: the first one in the first block that holds it.
        speaks = np.zeros(len(at), bool)
        speaks[index[tied & ~answers.of(~DEEP, names)]] = True
        tied = tied[inverse]
        known = _cover(n, at[tied], at[tied] + self.v)
        spoken = _cover(n, at[speaks], at[speaks] + self.v)
        return np.flatnonzero((open_ & ~known) | spoken), known


def _ends(block: Block, at: np.ndarray) -> np.ndarray:
    return block.bounds[np.searchsorted(block.bounds, at, "right")]


def _cover(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A mask of the positions in any ``[first, end)``."""
    some = end > first
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, first[some], 1)
    np.add.at(edges, end[some], -1)
    return np.cumsum(edges[:-1]) > 0


def _shared(answers: Answers, level: int, keys: np.ndarray) -> np.ndarray:
    names, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return (answers.of(level, names) | (counts > 1))[inverse]


def _result(block: Block, removed: np.ndarray) -> pa.Table:
    edges = np.diff(np.concatenate([[0], removed.view(np.int8), [0]]))
    cut = np.zeros(len(removed) + 1, bool)
    cut[block.bounds] = True
    inside = np.append(removed, False)
    before = np.append(False, removed)
    starts = np.flatnonzero(inside & ((edges == 1) | cut))
    ends = np.flatnonzero(before & ((edges == -1) | cut))
    owner = np.searchsorted(block.bounds, starts, "right") - 1
    slot = np.searchsorted(owner, np.arange(len(block.ids) + 1))
    rows = {name: [] for name in _ARROW.names}
    rows["doc_id"] = block.ids
    for i in range(len(block.ids)):
        begin, end = block.bounds[i], block.bounds[i + 1]
        digest, at, gone, spans = hashlib.sha256(), begin, 0, []
        for s, e in zip(starts[slot[i] : slot[i + 1]], ends[slot[i] : slot[i + 1]]):
            digest.update(block.data[at:s])
            spans.append({"start": s - begin, "end": e - begin})
            at, gone = e, gone + e - s
        digest.update(block.data[at:end])
        rows["n_bytes"].append(end - begin)
        rows["n_removed"].append(gone)
        rows["n_spans"].append(len(spans))
        rows["kept_sha256"].append(digest.hexdigest())
        rows["spans"].append(spans)
    return pa.table(rows, _ARROW)


def repeated_bytes(
    docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Maximal spans of bytes covered by a ``length``-byte string that starts twice or more.

    ``docs`` has doc_id and text; other columns are ignored. Every row is a document, also
    rows with equal or null ids; a null text is empty. Matches stay inside documents and may
    overlap. An empty table gives no rows. The result is stored in the shared folder.
    """
    if length < 1:
        raise ValueError("length must be positive")
    cover = _Cover(length)
    blocks = BlockTable(texts(docs), "suffixes", block_bytes=block_bytes)

    def sampled(block, answers):
        return np.unique(H.window_hashes(block.data, cover.samples(block), cover.depth))

    def deep(block, answers):
        return np.unique(cover.deep(block, cover.surviving(block, answers))[1])

    def open_starts(block, answers):
        starts, _ = cover.candidates(block, answers)
        return np.unique(H.window_hashes(block.data, starts, length))

    def finish(block, answers):
        starts, known = cover.candidates(block, answers)
        keys = H.window_hashes(block.data, starts, length)
        known[starts[_shared(answers, STARTS, keys)]] = True
        known = np.flatnonzero(known)
        return _result(block, _cover(len(block.data), known, known + length))

    blocks.ask(0, sampled, short=True)
    blocks.ask(DEEP, deep, order=True)
    blocks.ask(STARTS, open_starts)
    result = staged(blocks.each(finish, SCHEMA), "suffix-dedup")
    blocks.close()
    return result


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(read(spark, sf_dir, "documents")).drop("spans")
