"""BPE encoding and decoding with one dynamic program per word.

Method: byte-pair encodings have a local test. A sequence of tokens is the encoding of a word
if and only if each token encodes itself and each two neighbours encode, put together, as
those two. So every prefix of a word has one last token: the one among the tokens that end
there, as an automaton over the vocabulary reports them, which is compatible with the last
token of the prefix before it. Back-pointers from the word's end give the exact ids; no merge
is ever applied.

Two neighbours are compatible if no merge joins them across their border. On the left of
the border stand, one after another, the nodes along the right edge of the first token's merge
tree, on the right those along the left edge of the second's, each from its own merge on
until its parent's. A merge across happens if its rank falls where both its parts stand.

Words are independent, so tasks keep the codes of words seen lately; the vocabulary (some
megabytes, fixed) is broadcast. Documents aren't shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.tables import read, ship_code

TOKENIZER = "word_bpe_49k.json"
WORDS_KEPT, PAIRS_KEPT = 100_000, 200_000
#: Longer words are encoded each time, so that what is kept stays small on any text.
LONGEST_KEPT = 64
ROWS_AT_ONCE = 256
_END = "\x00"
_NEVER = 1 << 60


def _byte_letters() -> list[str]:
    """The usual byte alphabet: printable bytes as they are, the others from 256 up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Bpe:
    """A tokenizer file of the kind BPE with an end-of-word suffix, as tasks use it."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for token, number in [*self.vocab.items(), *self.special.items()]:
            self.tokens[number] = token
        self.parts = {}
        self.ranks = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = self.vocab[left], self.vocab[right]
            self.ranks[pair] = rank
            self.parts[self.vocab[left + right]] = (*pair, rank)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find_words = regex.compile(pattern).findall
        self.split_special = re.compile(f"({'|'.join(map(re.escape, self.special))})").split
        self.letters = dict(enumerate(_byte_letters()))
        self.automaton = ahocorasick.Automaton()
        for token, number in self.vocab.items():
            if self._encodes_itself(number):
                body = token.removesuffix(suffix) + _END if token.endswith(suffix) else token
                self.automaton.add_word(body, (number, len(body)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """The nodes on one edge of a token's merge tree with the ranks they stand from and to."""
        out, until = [], _NEVER
        while True:
            left, right, rank = self.parts.get(token, (-1, -1, -1))
            out.append((token, rank, until))
            if rank < 0:
                return out
            token, until = (left, right)[side], rank

    def _apart(self, left: int, right: int, until: int = _NEVER) -> bool:
        for x, made_x, gone_x in self._edge(left, 1):
            for y, made_y, gone_y in self._edge(right, 0):
                rank = self.ranks.get((x, y))
                # Of equal ranks the leftmost merge comes first.
                if rank is not None and max(made_x, made_y) < rank < min(gone_x, until) and rank <= gone_y:
                    return False
        return True

    def _encodes_itself(self, token: int) -> bool:
        todo = [token]
        while todo:
            left, right, rank = self.parts.get(todo.pop(), (-1, -1, -1))
            if rank >= 0:
                if not self._apart(left, right, rank):
                    return False
                todo += [left, right]
        return True

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(left, right)
        return known

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word of the pattern, by prefixes."""
        text = word.encode().decode("latin-1").translate(self.letters) + _END
        last = [-1] * (len(text) + 1)
        back = [0] * (len(text) + 1)
        last[0] = 0
        compatible = self.compatible
        for end, (token, size) in self.automaton.iter(text):
            begin = end + 1 - size
            if last[end + 1] < 0 and last[begin] >= 0 and (not begin or compatible(last[begin], token)):
                last[end + 1], back[end + 1] = token, begin
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]

    def _codes(self, text: str) -> list[bytes]:
        text = unicodedata.normalize("NFC", text)
        # One character at a time: a sigma at a word's end is no exception here.
        text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        words, out = self.words, []
        for word in self.find_words(text):
            code = words.get(word)
            if code is None:
                if len(words) >= WORDS_KEPT:
                    words.clear()
                code = np.array(self.encode_word(word), "<u4").tobytes()
                if len(word) <= LONGEST_KEPT:
                    words[word] = code
            out.append(code)
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens in the text are known."""
        out = []
        for part in self.split_special(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out += self._codes(part)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Tokens with a space between; this kind of file has no other decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


_loaded: dict[str, Bpe] = {}


def _bpe(text: str) -> Bpe:
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = Bpe(text)
    return _loaded[key]


def _columns(docs: DataFrame, source: str, fields: list[T.StructField], path: str | None, work) -> DataFrame:
    """``docs`` with ``fields``, whose values ``work(bpe, value of source)`` gives; one Python pass."""
    spark = docs.sparkSession
    ship_code(spark)
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())
    new = [f.name for f in fields]
    docs = docs.withColumn("_source", F.col(source))
    docs = docs.select(*[c for c in docs.columns if c not in (*new, "_source")], "_source")
    schema = T.StructType([*docs.schema.fields[:-1], *fields])
    kinds = [pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.string() for f in fields]
    names = schema.names

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(sent.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                rows = [work(bpe, x) for x in part.column(part.num_columns - 1).to_pylist()]
                made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=names)

    return docs.mapInArrow(each, schema)


def encoded(docs: DataFrame, path: str | None = None, source: str = "text", target: str = "ids") -> DataFrame:
    """``docs`` with the ids of a text column as binary, little-endian unsigned 32-bit integers.

    A null text is empty, and an empty text has no ids. Other columns and repeated rows stay;
    columns called ``target`` or ``_source`` are replaced. ``path`` names a tokenizer file on
    the driver.
    """
    field = T.StructField(target, T.BinaryType())
    return _columns(docs, source, [field], path, lambda bpe, text: (bpe.encode(text or ""),))


def decoded(docs: DataFrame, path: str | None = None, source: str = "ids", target: str = "decoded") -> DataFrame:
    """``docs`` with the text of ids made by ``encoded``; null ids are none."""
    field = T.StructField(target, T.StringType())
    return _columns(docs, source, [field], path, lambda bpe, ids: (bpe.decode(ids or b""),))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` and ``decoded`` in one pass: ``docs`` with ``ids`` and ``decoded``."""
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]

    def work(bpe, text):
        ids = bpe.encode(text or "")
        return ids, bpe.decode(ids)

    return _columns(docs, "text", fields, path, work)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
