"""Benchmark decontamination with an FM-index per training shard.

Method: a task takes its documents in shards of some megabytes of text. A shard's words are
mapped to the alphabet of the phrases; stretches of known words become one sequence, each
stretch with an end mark of its own. The sequence gets a suffix array, its Burrows-Wheeler
transform a wavelet matrix, and every eighth position of a stretch a suffix sample. All test
phrases are searched backwards together, a word at a time, by ranks in the wavelet matrix;
occurrences walk back to the next sample. Their word spans are merged per document.

Words outside the alphabet stand in no phrase, so leaving them out loses nothing. Phrases
come to the tasks in blocks of at most ``PHRASES``; with more of them, documents pass through
one more search per block and their findings are added up, so nothing that is broadcast
grows with the benchmark. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm import hashing as H
from airledger.llm.tables import passing, read, ship_code, staged

WINDOW = 10
PHRASES = 400_000
SHARD_BYTES = 4 << 20
SAMPLE = 8
#: Neither digit nor lower-case letter nor beyond ASCII.
_PARTS = np.array([b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) for b in range(256)])

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = [
    T.StructField("_n_words", T.LongType()),
    T.StructField("_word_spans", T.ArrayType(_SPAN)),
    T.StructField("_byte_spans", T.ArrayType(_SPAN)),
    T.StructField("_items", T.ArrayType(T.LongType())),
]


class Words:
    """The words of some texts as hashes, with the bytes they come from."""

    def __init__(self, texts: list[bytes]) -> None:
        self.bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.bounds[1:])
        data = H.ASCII_LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        self.starts, self.ends = H.words(data, self.bounds, _PARTS[data])
        self.hashes = H.word_hashes(data, self.starts, self.ends)
        #: Where the words of each text begin among all words.
        self.cuts = np.searchsorted(self.starts, self.bounds)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbol per level."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(bool)
            counts = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=counts[1:])
            self.levels.append((bit, counts, len(symbols) - counts[-1]))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        lo, hi = np.zeros(len(ends), np.int64), ends.astype(np.int64)
        for bit, counts, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            lo = np.where(one, zeros + counts[lo], lo - counts[lo])
            hi = np.where(one, zeros + counts[hi], hi - counts[hi])
        return hi - lo


class FmIndex:
    """Over a sequence of symbols from 1 up, 0 marking the end of each stretch."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        n = len(symbols)
        marks = symbols == 0
        ranks = symbols.astype(np.int64) + marks.sum()
        ranks[marks] = np.arange(marks.sum())
        reach = 1
        while True:  # prefix doubling; end marks differ, so it stops at the longest stretch
            after = np.full(n, -1, np.int64)
            after[:-reach] = ranks[reach:]
            keys = ranks * (n + alphabet + 2) + after + 1
            order = np.argsort(keys, kind="stable")
            new = np.ones(n, bool)
            new[1:] = keys[order[1:]] != keys[order[:-1]]
            ranks = np.empty(n, np.int64)
            ranks[order] = np.cumsum(new) - 1
            reach *= 2
            if new.all() or reach >= n:
                break
        before = np.where(order > 0, symbols[order - 1], 0)
        self.transform = before
        self.matrix = WaveletMatrix(before, max(1, int(alphabet).bit_length()))
        self.less = np.zeros(alphabet + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=alphabet + 1), out=self.less[1:])
        starts = np.ones(n, bool)
        starts[1:] = marks[:-1]
        begin = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
        sampled = (np.arange(n) - begin) % SAMPLE == 0
        self.sampled = sampled[order]
        self.positions = order[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase; phrases fill rows from the right."""
        first = np.zeros(len(phrases), np.int64)
        last = np.full(len(phrases), len(self.transform), np.int64)
        width = phrases.shape[1]
        for step in range(width):
            live = np.flatnonzero((lengths > step) & (first < last))
            symbols = phrases[live, width - 1 - step]
            base = self.less[symbols]
            first[live] = base + self.matrix.rank(symbols, first[live])
            last[live] = base + self.matrix.rank(symbols, last[live])
        return first, last

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: walk back to a sample, then add the steps."""
        rows, out = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.arange(len(rows))
        steps = 0
        while len(walking):
            there = self.sampled[rows[walking]]
            done = walking[there]
            out[done] = self.positions[self.sample_rank[rows[done]]] + steps
            walking = walking[~there]
            symbols = self.transform[rows[walking]]
            rows[walking] = self.less[symbols] + self.matrix.rank(symbols, rows[walking])
            steps += 1
        return out


class Phrases:
    """A block of benchmark windows in numbers; what tasks receive."""

    def __init__(self, items: list[int | None], windows: list[list[int]]) -> None:
        self.items = items
        lengths = np.array([len(w) for w in windows], np.int64)
        table = np.zeros((len(windows), max(lengths, default=0)), np.int64)
        for i, window in enumerate(windows):
            table[i, table.shape[1] - len(window) :] = window
        flat = np.unique(table.view(np.uint64)[np.arange(table.shape[1]) >= (table.shape[1] - lengths)[:, None]])
        self.alphabet = flat
        ids = np.searchsorted(flat, table.view(np.uint64)) + 1
        ids[np.arange(table.shape[1]) < (table.shape[1] - lengths)[:, None]] = 0
        self.phrases, self.owner = np.unique(ids, axis=0, return_inverse=True)
        self.owner = self.owner.ravel()
        self.by_phrase = np.argsort(self.owner, kind="stable")
        self.owner_cuts = np.searchsorted(
            self.owner[self.by_phrase], np.arange(len(self.phrases) + 1)
        )
        self.lengths = (self.phrases > 0).sum(axis=1)

    def items_of(self, phrases: np.ndarray) -> list[int]:
        found = set()
        for p in phrases:
            lo, hi = self.owner_cuts[p], self.owner_cuts[p + 1]
            found.update(self.items[i] for i in self.by_phrase[lo:hi])
        found.discard(None)
        return list(found)

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """``(phrase, index of its first word)`` of all occurrences in a shard."""
        nothing = np.zeros(0, np.int64)
        if not len(self.phrases) or not len(words.hashes):
            return nothing, nothing
        near = np.zeros(1 << 16, bool)
        near[(self.alphabet & np.uint64(0xFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(near[(words.hashes & np.uint64(0xFFFF)).astype(np.int64)])
        ids = np.minimum(np.searchsorted(self.alphabet, words.hashes[at]), len(self.alphabet) - 1)
        known = self.alphabet[ids] == words.hashes[at]
        at, ids = at[known], ids[known] + 1
        # Stretches of neighbouring known words of one text, if long enough for any phrase.
        text = np.searchsorted(words.cuts, at, "right")
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(text) > 0)
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(at)))
        keep = np.repeat(size >= self.lengths.min(), size)
        at, ids, new = at[keep], ids[keep], new[keep]
        if not len(at):
            return nothing, nothing
        begin = np.append(np.flatnonzero(new)[1:], len(at))  # an end mark goes before these
        symbols, places = np.insert(ids, begin, 0), np.insert(at, begin, -1)
        index = FmIndex(symbols, len(self.alphabet))
        first, last = index.search(self.phrases, self.lengths)
        found = np.flatnonzero(first < last)
        counts = last[found] - first[found]
        phrase = np.repeat(found, counts)
        rows = np.arange(counts.sum()) + np.repeat(first[found] - np.append(0, np.cumsum(counts)[:-1]), counts)
        return phrase, places[index.locate(rows)]


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.int64()))])
    for batch in batches:
        words = Words([(t or "").encode() for t in batch[1].to_pylist()])
        hashes = words.hashes.view(np.int64)
        rows = {"item_id": [], "words": []}
        for item, lo, hi in zip(batch[0].to_pylist(), words.cuts[:-1], words.cuts[1:]):
            for at in range(lo, max(lo + 1, hi - window + 1) if hi > lo else lo):
                rows["item_id"].append(item)
                rows["words"].append(hashes[at : min(hi, at + window)])
        yield pa.RecordBatch.from_pydict(rows, schema)


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def _search_shard(table: pa.Table, phrases: Phrases) -> pa.Table:
    """``table`` with its findings, added to those of earlier phrase blocks."""
    texts = [t or b"" for t in table["_text"].cast(pa.binary()).to_pylist()]
    words = Words(texts)
    phrase, at = phrases.occurrences(words)
    edges = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + phrases.lengths[phrase] if len(at) else at, -1)
    hit = np.cumsum(edges[:-1]) > 0
    text = np.searchsorted(words.cuts, at, "right") - 1
    hits = {int(i): np.unique(phrase[text == i]) for i in np.unique(text)} if len(at) < 64 else {}
    if len(at) >= 64:
        order = np.lexsort((phrase, text))
        cuts = np.flatnonzero(np.append(True, np.diff(text[order]) > 0))
        for lo, part in zip(cuts, np.split(phrase[order], cuts[1:])):
            hits[int(text[order[lo]])] = np.unique(part)
    spans, byte_spans, items = [], [], []
    earlier = [table[f.name].to_pylist() for f in FOUND[1:]] if FOUND[1].name in table.column_names else None
    for i in range(len(texts)):
        lo, hi = words.cuts[i], words.cuts[i + 1]
        own, own_bytes, own_items = [], [], []
        if i in hits:
            marks = np.diff(np.concatenate([[0], hit[lo:hi].view(np.int8), [0]]))
            for s, e in zip(np.flatnonzero(marks == 1), np.flatnonzero(marks == -1)):
                own.append((int(s), int(e)))
                begin = words.bounds[i]
                own_bytes.append((int(words.starts[lo + s] - begin), int(words.ends[lo + e - 1] - begin)))
            own_items = phrases.items_of(hits[i])
        if earlier is not None:
            own += [(x["start"], x["end"]) for x in earlier[0][i]]
            own_bytes += [(x["start"], x["end"]) for x in earlier[1][i]]
            own_items = [*{*own_items, *earlier[2][i]}]
        spans.append(_merged(own))
        byte_spans.append(_merged(own_bytes))
        items.append(own_items)
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    out = table.select([c for c in table.column_names if c not in {f.name for f in FOUND}])
    for field, values, kind in zip(
        FOUND,
        (np.diff(words.cuts), spans, byte_spans, items),
        (pa.int64(), pair, pair, pa.list_(pa.int64())),
    ):
        out = out.append_column(field.name, pa.array(values, kind))
    return out


def _search(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = [x or 0 for x in pc.binary_length(batch.column("_text")).to_pylist()]
        begin = 0
        for i, n in enumerate(sizes):
            size += n
            if size >= SHARD_BYTES:
                held.append(batch.slice(begin, i + 1 - begin))
                yield from _search_shard(pa.Table.from_batches(held), phrases).to_batches()
                held, size, begin = [], 0, i + 1
        if begin < len(sizes):
            held.append(batch.slice(begin))
    if held:
        yield from _search_shard(pa.Table.from_batches(held), phrases).to_batches()


def phrase_blocks(benchmark: DataFrame, window: int, most: int) -> Iterator[Phrases]:
    """The benchmark's windows in blocks of about ``most``, each small enough to broadcast."""
    windows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: _windows(batches, window), "item_id bigint, words array<bigint>"
    )
    windows = staged(windows, "phrases")
    blocks = -(-windows.count() // most) or 1
    place = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))
    for number in range(blocks):
        rows = windows.where(place == number).distinct().toArrow()
        yield Phrases(rows["item_id"].to_pylist(), rows["words"].to_pylist())


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = PHRASES
) -> DataFrame:
    """``docs`` with all its columns and what of ``benchmark`` occurs in each text.

    Added are ``_n_words``, ``_word_spans`` and ``_byte_spans`` (merged, end exclusive, bytes of
    the text in UTF-8) and ``_items`` (distinct item ids, in no order). Columns of these names in
    ``docs`` are replaced. A null text has no words; items without words have no windows;
    windows of items without an id are found, but no id can be listed for them. Repeated rows
    stay as they are, and an empty table or benchmark gives empty findings.
    """
    spark = docs.sparkSession
    ship_code(spark)
    names = {f.name for f in FOUND}
    found = docs.drop(*names, "_text").withColumn("_text", F.col("text").cast("string"))
    plain = found.schema.fields
    schema = T.StructType(plain + FOUND)
    for phrases in phrase_blocks(benchmark, window, most):
        sent = spark.sparkContext.broadcast(phrases)
        found = found.mapInArrow(lambda batches, sent=sent: _search(batches, sent.value), schema)
    return found.drop("_text")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with benchmark passages cut out of the texts, ``n_chars`` following.

    Texts without a finding stay as they are, also null ones. A text cut to nothing but white
    space goes, with its row.
    """
    return passing(docs, lambda d: _cut(d, benchmark))


def _cut(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spans = F.col("_byte_spans")
    data = F.encode("text", "UTF-8")
    # What lies between the spans, and after the last one.
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length("text").cast("long")))
    parts = F.zip_with(
        begins,
        ends,
        lambda b, e: F.decode(
            F.substring(data, (b + 1).cast("int"), (e - b).cast("int")), "UTF-8"
        ),
    )
    found = contamination(docs, benchmark).withColumn("_hit", F.size(spans) > 0)
    text = F.when(F.col("_hit"), F.array_join(parts, "")).otherwise(F.col("text"))
    cut = found.withColumn("_kept", text)
    return cut.where("not _hit or _kept rlike '[^\\\\x20\\\\x09-\\\\x0D]'").select(
        *[
            F.col("_kept").alias(c)
            if c == "text"
            else F.when(F.col("_hit"), F.length("_kept").cast(kind)).otherwise(F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(c)
            for c, kind in docs.dtypes
        ]
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("_word_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    items = F.array_join(F.array_sort(F.transform("_items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
