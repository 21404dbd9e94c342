"""Operator 10: language-model scoring by cross-entropy difference.

Two word bigram models, one of a target set and one of the whole corpus, share one
vocabulary: all words of the corpus, and LENGTHS classes for words that are not in it.
Both back off alike, by interpolating bigrams with
unigrams. A document's score is the mean over its tokens of background loss
minus target loss, in bits: above zero it reads more like the target.

All counts are exact, come from whole texts of all documents and are all kept, in a
written table that grows with the corpus. Words and bigrams are 64-bit hashes,
dealt into parts by their range. A block of documents asks the parts for each of its
words and bigrams once, however often they occur, so a common one is no more work
for its part than any other. What returns to the block are totals, in the order
in which it asked.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import words as w
from sigloom.llm.shared import bounded, dropped, released, written

#: Classes of words that are not in the corpus; each has no counts and is smoothed like a word.
LENGTHS = 16
#: Bytes of text in a block and for each part of the counts, tokens counted at once, entries in a row of the table.
BLOCK, PART, FLUSH, ROW = 1 << 24, 1 << 23, 2_500_000, 1 << 16
#: Kinds of rows, and how many counts an entry has: target and background, and for words the same without last words of texts.
WORD, PAIR, CUT = 0, 1, 2
COLUMNS = {WORD: 4, PAIR: 2, CUT: 2}
COUNTS = "kind int, part int, keys binary, counts binary, left binary"


def _packed(counts: np.ndarray) -> bytes:
    """Columns of counts in as few bytes as hold the largest, first bytes first, which compresses well."""
    size = max(1, -(-int(counts.max()).bit_length() // 8))
    return np.ascontiguousarray(counts.T.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def _unpacked(data: bytes, n: int, columns: int) -> np.ndarray:
    size = len(data) // (n * columns)
    flat = np.zeros((n * columns, 8), np.uint8)
    flat[:, :size] = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return flat.view("<i8").reshape(columns, n).T


def _coded(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as the first one, their number and the gaps."""
    return np.array([keys[0], len(keys)], np.uint64).tobytes() + (_packed(np.diff(keys)[:, None]) if len(keys) > 1 else b"")


def _number(data: bytes) -> int:
    return int(np.frombuffer(data, np.uint64, 1, 8)[0])


def _decoded(data: bytes) -> np.ndarray:
    keys = np.repeat(np.frombuffer(data, np.uint64, 1), _number(data))
    if len(keys) > 1:
        keys[1:] += np.cumsum(_unpacked(data[16:], len(keys) - 1, 1)[:, 0].view(np.uint64))
    return keys


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their summed counts, and where each is first."""
    found, at, place = np.unique(keys, return_index=True, return_inverse=True)
    return found, np.column_stack([np.bincount(place, c, len(found)) for c in counts.T]).astype(np.int64), at


def _ranges(keys: np.ndarray, parts: int):
    """(part, begin, end) of the parts that sorted keys fall into."""
    part = ((keys >> w.U(32)) * w.U(parts) >> w.U(32)).astype(np.int64)
    begin = np.flatnonzero(np.diff(part, prepend=-1))
    yield from zip(part[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(keys)])


def _entries(kind: int, keys: np.ndarray, counts: np.ndarray, parts: int, left: np.ndarray | None = None, most: int | None = None):
    """Rows (COUNTS) of sorted keys and their counts, one a part or, with ``most``, of so many keys at most."""
    for part, begin, end in _ranges(keys, parts):
        for i in range(begin, end, most or end - begin):
            j = min(end, i + (most or end))
            yield kind, part, _coded(keys[i:j]), _packed(counts[i:j]), None if left is None else left[i:j].tobytes()


def _arrow(rows, names=("kind", "part", "keys", "counts", "left")) -> pa.Table:
    kinds = {"kind": pa.int32(), "part": pa.int32()} | dict.fromkeys(("block", "n", "target", "background"), pa.int64())
    rows = list(rows)
    return pa.table({c: pa.array([r[k] for r in rows], kinds.get(c, pa.binary())) for k, c in enumerate(names)})


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word (A-Z as a-z) and of it with the word before, its text, and the first word of each text."""
    start, stop, first = w.words(data, at)
    hashes = w.word_hashes(data, start, stop, fold=True)
    return hashes, w.grams(hashes, 2), np.repeat(np.arange(len(at) - 1), np.diff(first)), first


def _inner(first: np.ndarray) -> np.ndarray:
    """Whether each word is followed by another of its text."""
    inner = np.ones(first[-1], bool)
    inner[first[1:][np.diff(first) > 0] - 1] = False
    return inner


def _own(column: pa.ChunkedArray) -> tuple[list, dict]:
    """The tokens of a block's texts, and by kind its keys and its own counts with none in the target."""
    column = pa.concat_arrays(column.cast(pa.large_string()).chunks)
    tokens = [_tokens(data, at) for _, _, data, at in w.blocks(column)]
    inner = [_inner(first) for _, _, _, first in tokens]
    words, pairs = np.concatenate([t[0] for t in tokens]), np.concatenate([t[1][i[:-1]] for t, i in zip(tokens, inner)])
    own = {}
    for kind, keys, columns in ((WORD, words, [np.ones(len(words)), np.concatenate(inner)]), (PAIR, pairs, [np.ones(len(pairs))])):
        found, many, _ = _summed(keys, np.column_stack(columns))
        own[kind] = found, np.column_stack([x for c in many.T for x in (0 * c, c)])
    return tokens, own


@dataclasses.dataclass
class Models:
    """All counts by key, dealt into ``parts``, and both models' totals of smoothed unigrams."""

    table: DataFrame
    parts: int
    total: np.ndarray
    mixed: float = 0.6

    def gains(self, tokens: tuple, words: tuple, pairs: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Per text the summed background loss minus target loss in bits, and the number of tokens.

        A bigram's probability is its count over its left word's; the left word's
        unlisted mass is spread like unigrams, and is the least that a bigram has.
        """
        hashes, keys, text, first = tokens
        mine = _found(hashes, *words)
        uni = (mine[:, :2] + 0.5) / self.total
        p = (1 - self.mixed) * uni
        if len(keys):
            # one count is set aside, and all of what is unlisted, for what a left word is not seen with
            total = mine[:-1, :2] + 1.0
            loose = 1 - mine[:-1, 2:] / total
            p[1:] += self.mixed * np.maximum(_found(keys, *pairs) / total, loose * uni[1:])
        begins = first[:-1][np.diff(first) > 0]
        p[begins] = uni[begins]  # nothing stands before a text's first word
        gain = np.log2(p[:, 0]) - np.log2(p[:, 1])
        return np.bincount(text, gain, len(first) - 1), np.diff(first)


def _found(keys: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of keys among sorted known ones; none for others."""
    if not len(known):
        return np.zeros((len(keys), counts.shape[1]), np.int64)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return counts[place] * (known[place] == keys)[:, None]


def _held(held: dict, data: np.ndarray, at: np.ndarray, wanted: np.ndarray, lefts: bool = False) -> int:
    """Add the keys of texts and what each counts for, with left words of bigrams or none; gives the number of tokens."""
    hashes, pairs, text, first = _tokens(data, at)
    hit = wanted[text]
    inner = _inner(first)
    ones = np.ones(len(hashes), bool)
    held[WORD].append((hashes, np.column_stack([hit, ones, hit & inner, inner]), hashes[:0]))
    same = inner[:-1]
    held[PAIR].append((pairs[same], np.column_stack([hit, ones])[:-1][same], hashes[:-1][same] if lefts else hashes[:0]))
    return len(hashes)


def _counted(rows: DataFrame, parts: int, lefts: bool) -> DataFrame:
    """Rows (COUNTS) over (text, is_target), summed in the worker first; with ``lefts`` bigrams keep their left words."""

    def run(batches):
        held = {WORD: [], PAIR: []}

        def flush():
            out = []
            for kind, some in held.items():
                keys, counts, left = (np.concatenate(x) for x in zip(*some))
                if len(keys):
                    found, many, at = _summed(keys, counts)
                    out += _entries(kind, found, many, parts, left[at] if lefts and kind == PAIR else None)
                some.clear()
            return _arrow(out).to_batches()

        size = 0
        for b in batches:
            wanted = b.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, at in w.blocks(b.column(0)):
                size += _held(held, data, at, wanted[i:j], lefts)
                if size > FLUSH:
                    yield from flush()
                    size = 0
        if held[WORD]:
            yield from flush()

    return rows.select("text", "is_target").mapInArrow(run, COUNTS)


def _combined(rows: DataFrame, parts: int, least: int) -> DataFrame:
    """Rows (COUNTS) with all entries of a part summed; bigrams of fewer than ``least`` leave rows CUT for their left words."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = any(r["kind"] != PAIR for r in rows)
        keys, counts = [], []
        for r in rows:
            k = _decoded(r["keys"])
            c = _unpacked(r["counts"], len(k), COLUMNS[r["kind"]])
            keys.append(k)
            counts.append(np.column_stack([0 * c, -c]) if r["kind"] == CUT else c)
        found, many, at = _summed(np.concatenate(keys), np.concatenate(counts))
        out = []
        if not words and least > 1:
            rare = many[:, 1] < least
            if rare.any():
                left = np.concatenate([np.frombuffer(r["left"], np.uint64) for r in rows])[at][rare]
                lefts, gone, _ = _summed(left, many[rare])
                out += _entries(CUT, lefts, gone, parts)
            found, many = found[~rare], many[~rare]
        return _arrow([*out, *_entries(WORD if words else PAIR, found, many, parts, most=ROW)])

    return rows.groupBy("part", F.col("kind") == PAIR).applyInArrow(run, COUNTS)


def fit(docs: DataFrame, target: DataFrame, least: int = 2) -> Models:
    """Models of the documents whose doc_id is in ``target``, and of all.

    Bigrams that occur ``least`` times or more in the corpus are listed, all others back off. Unigrams are
    smoothed by one half of a count.
    """
    bounded(docs.sparkSession)
    rows = docs.join(target.select("doc_id").distinct().withColumn("is_target", F.lit(True)), "doc_id", "left").select("text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    parts = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART
    counted = _counted(rows, parts, least > 1)
    if least > 1:
        counted = written(counted, "counted")
        pairs = written(_combined(counted.where(F.col("kind") == PAIR), parts, least), "pairs")
        words = _combined(counted.where(F.col("kind") == WORD).unionByName(pairs.where(F.col("kind") == CUT)), parts, least)
        table = written(words.unionByName(pairs.where(F.col("kind") == PAIR)), "counts")
        dropped(counted, pairs)
    else:
        table = written(_combined(counted, parts, least), "counts")

    def totals(batches):
        for b in batches:
            for keys, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = _number(keys)
                t = _unpacked(counts, n, COLUMNS[WORD])[:, :2].sum(axis=0)
                yield pa.record_batch([pa.array([n]), pa.array(t[:1]), pa.array(t[1:])], names=["n", "target", "background"])

    sums = table.where(F.col("kind") == WORD).select("keys", "counts").mapInArrow(totals, "n long, target long, background long").agg(F.sum("n"), F.sum("target"), F.sum("background")).first()
    n, *tokens = (x or 0 for x in sums)
    released(docs.sparkSession)  # the shuffles of counting outlive the write by one job
    return Models(table, parts, np.array(tokens) + 0.5 * (n + LENGTHS))


def _scored(models: Models):
    """Scores of a block's texts, from answers (kind, part, counts): the totals of the block's keys in a part, where they differ from its own counts."""
    maths = Models(None, models.parts, models.total, models.mixed)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(texts):
            return pa.table({"doc_id": texts["doc_id"], "n_tokens": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        tokens, own = _own(texts["text"])
        places = {k: {part: slice(i, j) for part, i, j in _ranges(keys, maths.parts)} for k, (keys, _) in own.items()}
        for k, part, counts in zip(*(answers[c].to_pylist() for c in ("kind", "part", "counts"))):
            mine = places[k][part]
            own[k][1][mine] = _unpacked(counts, mine.stop - mine.start, COLUMNS[k])
        gain, n = (np.concatenate(x) for x in zip(*(maths.gains(t, own[WORD], own[PAIR]) for t in tokens)))
        return pa.table({"doc_id": texts["doc_id"], "n_tokens": pa.array(n.astype(np.int64)), "score": pa.array(gain / np.maximum(n, 1))})

    return run


def _sizes(docs: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of text."""
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    return rows, size or 0


def score_corpus(docs: DataFrame, target: DataFrame) -> DataFrame:
    """What ``score(docs, fit(docs, target, least=1))`` gives, with texts and counts moved once less.

    Texts are dealt into blocks by doc_id, and the ids of targets with them, so that no join has to flag them
    first; ids with very many texts, or none, are dealt by text as well. A block sends its own counts to the parts, which sum them
    and send back those totals that differ. All words and bigrams count, from one occurrence on. Rows that
    :func:`score` speaks of get the same here.
    """
    bounded(docs.sparkSession)
    rows, size = _sizes(docs)
    parts, blocks = 1 + size // PART, 1 + size // BLOCK
    most = docs.where("doc_id is not null").groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    salts = 1 + most * blocks // max(1, rows)
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.pmod(F.xxhash64("text"), F.lit(salts)))
    texts = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", salt), F.lit(blocks)).alias("block"))
    ids = target.where("doc_id is not null").select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).distinct()
    ids = ids.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    ids = ids.select("doc_id", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(blocks)).alias("block"))

    def counted(texts: pa.Table, ids: pa.Table) -> pa.Table:
        out, names = [], ("block", "kind", "part", "keys", "counts")
        if len(texts):
            block, held = texts["block"][0].as_py(), {WORD: [], PAIR: []}
            wanted = pc.is_in(texts["doc_id"], ids["doc_id"].combine_chunks()).to_numpy()
            for i, j, data, at in w.blocks(pa.concat_arrays(texts["text"].cast(pa.large_string()).chunks)):
                _held(held, data, at, wanted[i:j])
            for kind, some in held.items():
                keys, many, _ = _summed(*(np.concatenate(x) for x in list(zip(*some))[:2]))
                out += [(block, kind, part, _coded(keys[i:j]), _packed(many[i:j])) for part, i, j in _ranges(keys, parts)] if len(keys) else []
        return _arrow(out, names)

    def summed(asked: pa.Table) -> pa.Table:
        kind, part = asked["kind"][0].as_py(), asked["part"][0].as_py()
        keys = [_decoded(x) for x in asked["keys"].to_pylist()]
        own = [_unpacked(c, len(k), COLUMNS[kind]) for k, c in zip(keys, asked["counts"].to_pylist())]
        found, many, _ = _summed(np.concatenate(keys), np.concatenate(own))
        out = [(None, kind, None, None, len(found), *many[:, :2].sum(axis=0).tolist())]
        for block, k, c in zip(asked["block"].to_pylist(), keys, own):
            total = many[np.searchsorted(found, k)]
            # the block itself takes its own counts for all, and none of them for the target's
            new = (total[:, ::2] > 0).any(axis=1) | (total[:, 1::2] != c[:, 1::2]).any(axis=1)
            if new.any():
                out.append((block, kind, part, _packed(total), None, None, None))
        return _arrow(out, ("block", "kind", "part", "counts", "n", "target", "background"))

    asked = texts.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(counted, "block long, kind int, part int, keys binary, counts binary")
    answers = written(asked.groupBy("part", "kind").applyInArrow(summed, "block long, kind int, part int, counts binary, n long, target long, background long"), "answers")
    sums = answers.where(F.col("block").isNull() & (F.col("kind") == WORD)).agg(F.sum("n"), F.sum("target"), F.sum("background")).first()
    n, *tokens = (x or 0 for x in sums)
    models = Models(None, parts, np.array(tokens) + 0.5 * (n + LENGTHS))
    released(docs.sparkSession)  # the shuffles of counting outlive the write by one job
    kind = docs.schema["doc_id"].dataType.simpleString()
    back = answers.where(F.col("block").isNotNull()).select("block", "kind", "part", "counts")
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_scored(models), f"doc_id {kind}, n_tokens long, score double")


def score(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_tokens and score, the mean difference of losses per token.

    A null or empty text has no tokens and scores 0. A null doc_id stays null and
    repeated rows score alike; an empty table gives an empty one; other columns
    are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = models.parts

    def asked(texts: pa.Table) -> pa.Table:
        block, (_, own) = texts["block"][0].as_py(), _own(texts["text"])
        rows = ((block, k, part, _coded(keys[i:j]), _packed(counts[i:j, 1::2])) for k, (keys, counts) in own.items() if len(keys) for part, i, j in _ranges(keys, parts))
        return _arrow(rows, ("block", "kind", "part", "keys", "counts"))

    def answered(questions: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if len(questions):
            k, part = questions["kind"][0].as_py(), questions["part"][0].as_py()
            listed = [_decoded(x) for x in known["keys"].to_pylist()]
            counts = np.concatenate([np.zeros((0, COLUMNS[k]), np.int64), *(_unpacked(c, len(x), COLUMNS[k]) for x, c in zip(listed, known["counts"].to_pylist()))])
            listed = np.concatenate([np.zeros(0, np.uint64), *listed])
            order = np.argsort(listed, kind="stable")
            listed, counts = listed[order], counts[order]
            for block, wanted, own in zip(*(questions[c].to_pylist() for c in ("block", "keys", "counts"))):
                wanted = _decoded(wanted)
                many = _found(wanted, listed, counts)
                new = (many[:, ::2] > 0).any(axis=1) | (many[:, 1::2] != _unpacked(own, len(wanted), COLUMNS[k] // 2)).any(axis=1)
                if new.any():
                    out.append((block, k, part, _packed(many)))
        return _arrow(out, ("block", "kind", "part", "counts"))

    # blocks follow from the rows themselves, so that they are the same whenever they are made
    blocks = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK
    released(docs.sparkSession)
    texts = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))
    questions = texts.groupBy("block").applyInArrow(asked, "block long, kind int, part int, keys binary, counts binary")
    known = models.table.select("kind", "part", "keys", "counts")
    answers = questions.groupBy("part", "kind").cogroup(known.groupBy("part", "kind")).applyInArrow(answered, "block long, kind int, part int, counts binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(models), f"doc_id {kind}, n_tokens long, score double")
