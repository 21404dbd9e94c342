"""Operator 1: byte-pair encoding and decoding.

A text is cut into pre-tokens; each pre-token's bytes form a doubly linked list
of symbols, and a priority queue of merge ranks says which neighbours to join
next. A queue entry whose symbols have changed meanwhile is stale and skipped.
Decoding concatenates the vocabulary's byte strings. Encoded pieces of text are
remembered per Python worker (a bounded memo), so a frequent word is merged once.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Fixed value of the vocabulary's format: how byte-level BPE splits text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same split for texts of no character beyond U+024F and no separator U+001C-U+001F, by the faster library.
COMMON = r"[\x00-\x1b\x20-\u024f]*"
_L, _N = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
COMMON_TOKENS = rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"
#: Pre-tokens that a worker remembers at most; beyond that it starts anew.
MEMO = 1_000_000


def byte_of_char() -> dict[str, int]:
    """The byte for each printable stand-in character of byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Model:
    """Vocabulary and merges as plain data, small and of fixed size: it can be broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_of_char()
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        raw = {k: bytes(map(to_byte.__getitem__, k)) for k in vocab if k not in self.special}
        self.strings: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for k, b in raw.items():
            self.strings[vocab[k]] = b
        for k, i in self.special.items():
            self.strings[i] = k.encode()
        self.first = [0] * 256
        for k, b in raw.items():
            if len(b) == 1:
                self.first[b[0]] = vocab[k]
        #: left << 20 | right -> rank, joined
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a] << 20 | vocab[b]] = (rank, vocab[a + b])


@functools.lru_cache(maxsize=4)
def load_model(path: str) -> Model:
    return Model(path)


def merge_symbols(symbols: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Join neighbours, lowest rank first and leftmost among equals, until no pair has a rank.

    A queue entry is rank and place in one integer. It is stale, and skipped, when
    the pair now at that place has another rank or none.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get, push, pop = merges.get, heapq.heappush, heapq.heappop
    queue = []
    for i in range(n - 1):
        found = get(symbols[i] << 20 | symbols[i + 1])
        if found:
            queue.append(found[0] << 32 | i)
    heapq.heapify(queue)
    while queue:
        entry = pop(queue)
        i = entry & 0xFFFFFFFF
        left, j = symbols[i], after[i]
        if left < 0 or j >= n:
            continue
        found = get(left << 20 | symbols[j])
        if not found or found[0] != entry >> 32:
            continue
        symbols[i] = joined = found[1]
        symbols[j] = -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            found = get(joined << 20 | symbols[k])
            if found:
                push(queue, found[0] << 32 | i)
        h = before[i]
        if h >= 0:
            found = get(symbols[h] << 20 | joined)
            if found:
                push(queue, found[0] << 32 | h)
    return [s for s in symbols if s >= 0]


class Memo(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit bytes, filled on demand."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> bytes:
        first = self.model.first
        ids = merge_symbols([first[b] for b in word.encode()], self.model.merges)
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = out
        return out


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: Model):
        self.model, self.memo = model, Memo(model)
        self.words = regex.compile(PRE_TOKENS)
        self.common, self.common_words = re.compile(COMMON), re.compile(COMMON_TOKENS)
        self.special = re.compile("(" + "|".join(map(re.escape, model.special)) + ")") if model.special else None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.special and "<" in text and self.special.search(text):
            parts = self.special.split(text)
            return b"".join(struct.pack("<I", self.model.special[p]) if i % 2 else self.plain(p) for i, p in enumerate(parts))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        words = self.common_words if self.common.fullmatch(text) else self.words
        return b"".join(map(self.memo.__getitem__, words.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        """The text in UTF-8; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.model.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


_codecs: dict[int, Codec] = {}


def codec_of(shared) -> Codec:
    """The worker's codec for a broadcast model; made once, so that its memo outlives a task."""
    if shared.id not in _codecs:
        _codecs.clear()
        _codecs[shared.id] = Codec(shared.value)
    return _codecs[shared.id]


class Shared:
    """A broadcast value with a key by which workers know it again."""

    def __init__(self, spark: SparkSession, value):
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = str(self.broadcast._jbroadcast.id()) + spark.sparkContext.applicationId

    @property
    def value(self):
        return self.broadcast.value

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``ids``: array<int>, the encoded whole text.

    A null text is an empty one and has no ids. Other columns are ignored, rows
    that repeat are encoded each on their own, and an empty table gives an empty
    one. Narrow: nothing is shuffled.
    """
    shared = Shared(docs.sparkSession, load_model(path))
    fields = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]

    def run(batches):
        codec = codec_of(shared)
        for b in batches:
            ids = [np.frombuffer(codec.encode(x or ""), "<i4") for x in b.column(b.num_columns - 1).to_pylist()]
            offsets = np.zeros(len(ids) + 1, "<i4")
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.concatenate(ids) if ids else np.zeros(0, "<i4")
            yield pa.record_batch([*b.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*(f.name for f in fields), "ids"])

    out = docs.select(*(docs[c].alias(f"k{i}") for i, c in enumerate(keep)), docs[text].alias("t")).mapInArrow(run, T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.toDF(*keep, "ids")


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``text``; null ids decode to the empty text."""
    shared = Shared(encoded.sparkSession, load_model(path))
    fields = [T.StructField(f"k{i}", encoded.schema[c].dataType) for i, c in enumerate(keep)]

    def run(batches):
        codec = codec_of(shared)
        for b in batches:
            texts = [codec.decode(np.asarray(x or [], "<u4").tobytes()).decode() for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.record_batch([*b.columns[:-1], pa.array(texts, pa.string())], names=[*(f.name for f in fields), "text"])

    out = encoded.select(*(encoded[c].alias(f"k{i}") for i, c in enumerate(keep)), encoded[ids].alias("t")).mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType())]))
    return out.toDF(*keep, "text")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every whole text in one pass; per row doc_id, n_tokens and digests.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers,
    ``decoded_sha256`` over the decoded text in UTF-8. A null text counts as
    empty; a null doc_id stays null.
    """
    shared = Shared(docs.sparkSession, load_model(path))

    def run(batches):
        codec, sha = codec_of(shared), hashlib.sha256
        for b in batches:
            n, one, two = [], [], []
            for x in b.column(1).to_pylist():
                ids = codec.encode(x or "")
                n.append(len(ids) // 4)
                one.append(sha(ids).hexdigest())
                two.append(sha(codec.decode(ids)).hexdigest())
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(one), pa.array(two)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
