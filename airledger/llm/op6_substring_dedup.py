"""Substring dedup by recompression of word sequences.

Method: words become symbols. The first round names runs of one symbol, and each round
splits the alphabet at random into left and right symbols and names every left-right pair.
A name is a 64-bit hash of what it stands for, so all tasks give equal text equal names
without a shared dictionary. Whether a symbol is formed depends only on words near by; that
interval is carried along, so equal windows show equal symbols for every symbol whose
interval they contain: their witnesses.

1. Spark shuffles the high-level symbols of all blocks and tells each block which of its
   symbols also stand elsewhere. A window with a witness that stands nowhere else is new.
2. The windows left, and windows without any witness, are compared as whole windows; the
   answer names earlier holders, blocks being numbered in document order.

Windows inside long runs have no witness and take step 2, so nothing depends on run length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from airledger.llm import hashing as H
from airledger.llm.blocks import BLOCK_BYTES, Answers, Block, BlockTable
from airledger.llm.tables import read, staged, texts

WINDOW = 20
ROUNDS = 3
SCHEMA = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
    "spans array<struct<start: bigint, end: bigint>>"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
SYMBOLS, WINDOWS = 0, 1
_FAR = 1 << 40


class Symbols:
    """A sequence of symbols with the interval of words each of them depends on."""

    def __init__(self, names: np.ndarray, docs: np.ndarray) -> None:
        at = np.arange(len(names))
        self.names, self.docs, self.lo, self.hi = names, docs, at, at + 1

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the symbol before depends on, and the one after; far off at a document's edge."""
        same = self.docs[1:] == self.docs[:-1]
        before, after = np.full(len(self.names), -_FAR), np.full(len(self.names), _FAR)
        before[1:][same] = self.lo[:-1][same]
        after[:-1][same] = self.hi[1:][same]
        return before, after

    def _keep(self, first: np.ndarray, last: np.ndarray, names: np.ndarray) -> None:
        self.lo, self.hi = self.lo[first], self.hi[last]
        self.docs, self.names = self.docs[first], names

    def runs(self) -> None:
        """Name maximal runs; where a run ends is seen from the symbols around it."""
        if not len(self.names):
            return
        before, after = self._neighbours()
        new = np.ones(len(self.names), bool)
        new[1:] = (self.names[1:] != self.names[:-1]) | (self.docs[1:] != self.docs[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(self.names)) - 1
        size = (last - first + 1).astype(np.uint64)
        names = np.where(size > 1, H.combine(self.names[first], size), self.names[first])
        self._keep(first, last, names)
        self.lo, self.hi = np.minimum(self.lo, before[first]), np.maximum(self.hi, after[last])

    def pairs(self, number: int) -> None:
        """Name each pair of a left symbol and a right symbol after it."""
        if not len(self.names):
            return
        before, after = self._neighbours()
        left = (H.combine(self.names, np.uint64(number)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(self.names), bool)  # with the next
        joins[:-1] = left[:-1] & ~left[1:] & (self.docs[1:] == self.docs[:-1])
        joined = np.append(False, joins[:-1])
        # A lone right symbol has seen what stands before it, a lone left one what follows.
        lone = ~joins & ~joined
        self.lo = np.where(lone & ~left, np.minimum(self.lo, before), self.lo)
        self.hi = np.where(lone & left, np.maximum(self.hi, after), self.hi)
        first = np.flatnonzero(~joined)
        last = first + joins[first]
        names = np.where(
            joins[first],
            H.combine(self.names[first], self.names[last], np.uint64(number)),
            self.names[first],
        )
        self._keep(first, last, names)


class _Words:
    """The words of a block, their windows and their witnesses."""

    def __init__(self, block: Block, window: int, rounds: int) -> None:
        self.window = window
        starts, ends = H.words(block.data, block.bounds)
        self.hashes = H.word_hashes(block.data, starts, ends)
        docs = np.searchsorted(block.bounds, starts, "right") - 1
        self.bounds = np.searchsorted(docs, np.arange(len(block.ids) + 1))
        symbols = Symbols(self.hashes, docs)
        symbols.runs()
        for number in range(rounds):
            symbols.pairs(number)
        lo, hi = symbols.lo, symbols.hi
        fits = (hi - lo <= window) & (lo >= self.bounds[symbols.docs])
        fits &= hi <= self.bounds[symbols.docs + 1]
        self.names, self.lo, self.hi = symbols.names[fits], lo[fits], hi[fits]
        self.starts = np.ones(len(starts), bool)
        for end in self.bounds[1:]:
            self.starts[max(0, end - window + 1) : end] = False

    def candidates(self, answers: Answers) -> tuple[np.ndarray, np.ndarray]:
        names, inverse, counts = np.unique(self.names, return_inverse=True, return_counts=True)
        alone = ~(answers.of(SYMBOLS, names) | (counts > 1))[inverse]
        edges = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(edges, np.maximum(0, self.hi[alone] - self.window), 1)
        np.add.at(edges, self.lo[alone] + 1, -1)
        at = np.flatnonzero(self.starts & (np.cumsum(edges[:-1]) == 0))
        return at, H.spans(H.prefix_sums(self.hashes), at, at + self.window)


def _result(block: Block, words: _Words, removed: np.ndarray) -> pa.Table:
    rows = {name: [] for name in _ARROW.names}
    rows["doc_id"] = block.ids
    for i in range(len(block.ids)):
        text = block.data[block.bounds[i] : block.bounds[i + 1]].tobytes().split()
        gone = removed[words.bounds[i] : words.bounds[i + 1]]
        spans = []
        if gone.any():
            edges = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
            pairs = zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))
            spans = [{"start": s, "end": e} for s, e in pairs]
            kept = b" ".join([text[j] for j in np.flatnonzero(~gone)])
        else:
            kept = b" ".join(text)
        rows["n_words"].append(len(text))
        rows["n_removed"].append(int(gone.sum()))
        rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        rows["spans"].append(spans)
    return pa.table(rows, _ARROW)


def repeated_words(
    docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Spans of words covered by a window whose word sequence also starts earlier.

    ``docs`` has doc_id and text; other columns are ignored. Every row is a document; a null
    text has no words. Documents come in the order of doc_id, null ids first; rows with
    equal ids by the hash of their text, then by place in the input, so equal rows give equal
    results up to which of them is called first. An empty table gives no rows. Spans count
    words. The result is stored in the shared folder.
    """
    if window < 1:
        raise ValueError("window must be positive")
    blocks = BlockTable(texts(docs), "recompression", ordered=True, block_bytes=block_bytes)

    def symbols(block, answers):
        return np.unique(_Words(block, window, rounds).names)

    def windows(block, answers):
        return np.unique(_Words(block, window, rounds).candidates(answers)[1])

    def finish(block, answers):
        words = _Words(block, window, rounds)
        at, keys = words.candidates(answers)
        names, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        again = answers.of(~WINDOWS, names)[inverse]
        again |= first[inverse] != np.arange(len(keys))
        edges = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(edges, at[again], 1)
        np.add.at(edges, at[again] + window, -1)
        return _result(block, words, np.cumsum(edges[:-1]) > 0)

    blocks.ask(SYMBOLS, symbols, short=True)
    blocks.ask(WINDOWS, windows, order=True)
    result = staged(blocks.each(finish, SCHEMA), "substring-dedup")
    blocks.close()
    return result


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(read(spark, sf_dir, "documents")).drop("spans")
