"""Operator 8: removal of long passages that repeat, by prefix-partitioned suffix trees.

A suffix is a word position with the words from it on. Each window of ``span`` words
holds an anchor, the least of its ANCHOR-word hashes; equal windows hold equal
anchors at one place, so windows whose anchor stands nowhere else are unique
and go at once. What is left is dealt to trees by prefixes of variable length: all suffixes
that begin shortly before an anchor go to the anchor's tree, whose prefix is the
anchor's words; an anchor that more than TREE places share is divided by
the prefix of whole windows instead, nodes of full depth where two suffixes already repeat.

A tree is built from its suffixes in the order of their words and the lengths
of neighbours' common prefixes, both from exact ranks of runs of one, two, four and
so on words. Its internal nodes at least ``span`` words deep give every suffix's longest
repeat; those that one further left contains are dropped, and what stays are the
maximal repeats, as far as the words carried around an anchor reach. Their union is removed.

Texts of equal words are one class; a class with copies repeats as a whole.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import words as w
from sigloom.llm.grouping import lists, whole_runs
from sigloom.llm.shared import bounded, dropped, written

#: Places that a tree takes; anchors with more are divided by longer prefixes. Rows of several trees worked on at once.
TREE, ROWS = 1000, 4000


def anchor_size(span: int) -> int:
    return max(1, 2 * span // 3)


def _documents(column: pa.Array):
    """For each block of texts: first row, texts, bytes, offsets, words' starts and stops, first word of each, words' hashes."""
    for i, j, data, at in w.blocks(column):
        start, stop, first = w.words(data, at)
        yield i, j - i, data, at, start, stop, first, w.word_hashes(data, start, stop)


def _digest(raw: bytes) -> bytes:
    return hashlib.sha256(b" ".join(raw.split())).digest()


def _class(digest: bytes) -> tuple[int, int]:
    """128 bits of the digest of a text's words, as two numbers."""
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True)


def _anchors(first: np.ndarray, hashes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the windows' anchors, the text of each, their hashes, and the first and last window that each is the anchor of.

    Places rise and stand once each; the first of equal hashes is a window's anchor.
    """
    k = anchor_size(span)
    begin, text = w.windows(first, span)
    if not len(begin):
        return begin, text, np.zeros(0, np.uint64), begin, begin
    grams = w.grams(hashes, k)
    seen = sliding_window_view(grams, span - k + 1)
    step = 1 << 16  # so that a text of any length costs one such copy at a time
    place = begin + np.concatenate([seen[begin[x : x + step]].argmin(axis=1) for x in range(0, len(begin), step)])
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]  # a place never falls back from window to window
    last = np.append(np.flatnonzero(new)[1:], len(place)) - 1
    return place[new], text[new], grams[place[new]], begin[new], begin[last]


def profile(docs: DataFrame, span: int) -> DataFrame:
    """Per row doc_id, th (hash of its text), class (c1, c2), n words, digest of its words, and its anchors."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for i, many, data, at, _, _, first, hashes in _documents(b.column(2)):
                _, text, anchor, _, _ = _anchors(first, hashes, span)
                raw = data.tobytes()
                sha = [_digest(raw[x:y]) for x, y in itertools.pairwise(at.tolist())]
                yield pa.record_batch(
                    [b.column(0).slice(i, many), b.column(1).slice(i, many), *(pa.array(c, pa.int64()) for c in zip(*map(_class, sha))), pa.array(np.diff(first)), pa.array([s.hex() for s in sha]), pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(many + 1)), pa.int32()), pa.array(anchor.view(np.int64)))],
                    names=["doc_id", "th", "c1", "c2", "n", "sha", "anchors"],
                )

    return docs.select("doc_id", "th", "text").mapInArrow(run, f"doc_id {kind}, th long, c1 long, c2 long, n long, sha string, anchors array<long>")


LEAF = "anchor long, around string, lead int, c1 long, c2 long, at int, until int, again boolean, hot long, ws array<struct<w1:long,w2:long>>, w1 long, w2 long, n long"
WINDOW = pa.struct([("w1", pa.int64()), ("w2", pa.int64())])
KINDS = {"anchor": pa.int64(), "around": pa.string(), "lead": pa.int32(), "c1": pa.int64(), "c2": pa.int64(), "at": pa.int32(), "until": pa.int32(), "again": pa.bool_(), "hot": pa.int64(), "ws": pa.list_(WINDOW), "w1": pa.int64(), "w2": pa.int64(), "n": pa.int64()}


def _leaves(many: int, **columns) -> pa.RecordBatch:
    """Rows LEAF of so many rows with these columns, the others null."""
    arrays = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(many, t) for c, t in KINDS.items()]
    return pa.record_batch(arrays, names=list(KINDS))


def suffixes(texts: DataFrame, span: int) -> DataFrame:
    """Rows LEAF of rows c1, c2, text and the anchors ``shared`` and, of those, ``hot``.

    A place of an anchor has the words that the windows it is the anchor of reach, of which ``lead`` stand before it; they
    are the words from ``at`` to ``until`` of its document. Of a document's places with equal words around one stands for all,
    ``again``; for the others there are only at and until. A place of a hot anchor has instead of words two hashes for each of its windows,
    the first of which begins at ``at``; besides there are rows that count such windows, some texts at once.
    """
    reach = span - anchor_size(span)

    def run(batches):
        for b in batches:
            c1, c2 = (b.column(k).to_numpy() for k in (0, 1))
            (shared, shared_at), (hot, hot_at) = lists(b.column(3)), lists(b.column(4))
            for i, many, data, at, start, stop, first, hashes in _documents(b.column(2)):
                place, text, anchor, from_, to = _anchors(first, hashes, span)
                cut = np.searchsorted(text, np.arange(many + 1))
                grams = (w.grams(hashes, span), w.grams(w.mix(hashes ^ w.SEED), span))
                raw, rows, full = data.tobytes(), [], []
                for k in range(many):
                    if _class(_digest(raw[at[k] : at[k + 1]])) != (c1[i + k], c2[i + k]):
                        continue
                    names = anchor[cut[k] : cut[k + 1]].view(np.int64)
                    here = np.isin(names, shared[shared_at[i + k] : shared_at[i + k + 1]])
                    names, (places, x_of, y_of) = names[here], (v[cut[k] : cut[k + 1]][here] for v in (place, from_, to))
                    many_of = np.isin(names, hot[hot_at[i + k] : hot_at[i + k + 1]])
                    full.append((names[many_of], x_of[many_of], y_of[many_of] + 1, np.full(many_of.sum(), i + k), np.full(many_of.sum(), first[k])))
                    low, seen = first[k], {}
                    for p, name, x, y in zip(*(v[~many_of].tolist() for v in (places, names, x_of, y_of + span))):
                        around = b" ".join(raw[start[x] : stop[y - 1]].split())
                        other_row = seen.setdefault((name, p - x, around), len(rows))
                        if other_row < len(rows):
                            rows.append((i + k, None, None, None, x - low, y - low, True))
                            rows[other_row] = (*rows[other_row][:6], True)
                        else:
                            rows.append((i + k, name, around.decode("utf-8", "replace"), p - x, x - low, y - low, False))
                if rows:
                    of, anchors, arounds, leads, begins, ends, agains = zip(*rows)
                    of = np.array(of)
                    yield _leaves(len(rows), anchor=anchors, around=arounds, lead=leads, c1=c1[of], c2=c2[of], at=begins, until=ends, again=agains)
                if full and any(len(f[0]) for f in full):
                    names, x, y, of, low = (np.concatenate(v) for v in zip(*full))
                    n = y - x
                    every = np.repeat(x - np.cumsum(n) + n, n) + np.arange(n.sum())
                    one, two = (g[every].view(np.int64) for g in grams)
                    listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.StructArray.from_arrays([pa.array(one), pa.array(two)], fields=list(WINDOW)))
                    yield _leaves(len(names), hot=names, ws=listed, c1=c1[of], c2=c2[of], at=x - low)
                    owner = np.repeat(names, n)
                    order = np.lexsort((two, one, owner))
                    owner, one, two = owner[order], one[order], two[order]
                    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
                    yield _leaves(len(new), hot=owner[new], w1=one[new], w2=two[new], n=np.diff(np.append(new, len(owner))))

    return texts.select("c1", "c2", "text", "shared", "hot").mapInArrow(run, LEAF)


def ranks(words: np.ndarray, most: int) -> dict[int, np.ndarray]:
    """For 1, 2, 4 and so on up to ``most`` the ranks of the runs of so many words from every place of every row."""
    out, size = {1: words}, 1
    while 2 * size <= most:
        last = out[size]
        after = np.zeros_like(last)
        after[:, :-size] = last[:, size:]
        pair = last * (int(last.max()) + 1) + after
        out[2 * size] = np.unique(pair, return_inverse=True)[1].reshape(pair.shape) + 1
        size *= 2
    return out


def repeats(tree: np.ndarray, words: np.ndarray, before: np.ndarray, length: np.ndarray, reach: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats of ``span`` words or more as (row, begin, end), in places of ``words``.

    Row r belongs to ``tree[r]`` and holds exact ids from 1 on (0: no word) at the places from ``reach - before[r]`` to
    ``reach + length[r]``; its suffixes are those that have ``span`` words or more, none of them beginning after ``reach``.
    """
    many, width = words.shape
    level = ranks(words, width)
    row, begin = np.nonzero(np.arange(reach + 1) >= (reach - before)[:, None])
    room = reach + length[row] - begin
    row, begin, room = row[room >= span], begin[room >= span], room[room >= span]
    sizes = sorted(level, reverse=True)
    # the order of the words, by the ranks of runs that follow each other and cover all
    keys, place = [], begin.copy()
    while (place < width).any():
        keys.append(np.where(place < width, level[sizes[0]][row, np.minimum(place, width - 1)], 0))
        place = place + sizes[0]
    order = np.lexsort((*reversed(keys), tree[row]))
    row, begin, room = row[order], begin[order], room[order]
    if len(row) < 2:
        return row[:0], begin[:0], begin[:0]
    a, b = slice(None, -1), slice(1, None)
    alike = tree[row[a]] == tree[row[b]]
    common = np.zeros(len(row) - 1, np.int64)
    x, y, some = begin[a].copy(), begin[b].copy(), np.flatnonzero(alike)
    for size in [sizes[0], *sizes]:
        fits = some[np.maximum(x[some], y[some]) + size <= width]
        same = fits[level[size][row[a][fits], x[fits]] == level[size][row[b][fits], y[fits]]]
        common[same] += size
        x[same] += size
        y[same] += size
    common = np.minimum(common, np.minimum(room[a], room[b]))
    # neighbours below one internal node of that depth; a suffix's deepest such node is that with a neighbour
    depth = np.zeros(len(row), np.int64)
    depth[a] = common
    depth[b] = np.maximum(depth[b], common)
    end = np.zeros((many, reach + 1), np.int64)
    deep = depth >= span
    end[row[deep], begin[deep]] = begin[deep] + depth[deep]
    furthest = np.maximum.accumulate(end, axis=1)
    end[:, 1:][end[:, 1:] <= furthest[:, :-1]] = 0  # contained in a repeat from further left
    row, begin = np.nonzero(end)
    return row, begin, end[row, begin]


def trees(leaves: DataFrame, span: int) -> DataFrame:
    """Rows (c1, c2, begin, end): the repeats among written LEAF rows with words."""
    reach = span - anchor_size(span)
    width = reach + span

    def run(batches):
        for t in whole_runs(batches, "anchor", ROWS):
            listed = pc.split_pattern(t["around"].combine_chunks(), " ")
            listed = pa.concat_arrays(listed.chunks) if isinstance(listed, pa.ChunkedArray) else listed
            n, before = pc.list_value_length(listed).to_numpy().astype(np.int64), t["lead"].to_numpy().astype(np.int64)
            words = np.zeros((t.num_rows, width), np.int64)
            row = np.repeat(np.arange(t.num_rows), n)
            words[row, np.arange(len(row)) + np.repeat(reach - before - np.cumsum(n) + n, n)] = listed.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
            row, begin, end = repeats(t["anchor"].to_numpy(), words, before, n - before, reach, span)
            # what repeats in its own document repeats as a whole
            own = np.flatnonzero(t["again"].to_numpy())
            row, begin, end = np.concatenate([row, own]), np.concatenate([begin, reach - before[own]]), np.concatenate([end, (reach - before + n)[own]])
            shift = t["at"].to_numpy()[row] - reach + before[row]
            yield pa.record_batch([*(pa.array(t[c].to_numpy()[row]) for c in ("c1", "c2")), pa.array((shift + begin).astype(np.int32)), pa.array((shift + end).astype(np.int32))], names=["c1", "c2", "begin", "end"])

    dealt = leaves.where("anchor is not null").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "around", "lead", "c1", "c2", "at", "again").mapInArrow(run, "c1 long, c2 long, begin int, end int")


def cleaned(texts: DataFrame, span: int) -> DataFrame:
    """Rows c1, c2, text, found (begin and end of repeats, in words) -> c1, c2, removed, sha, and kept, the text that stays."""

    def run(batches):
        for b in batches:
            c1, c2 = (b.column(k).to_numpy() for k in (0, 1))
            begins, found_at = lists(b.column(3))
            ends, _ = lists(b.column(4))
            row, removed, sha, kept = [], [], [], []
            for i, j, data, at in w.blocks(b.column(2)):
                start, _, first = w.words(data, at)
                for k in range(j - i):
                    raw = data[at[k] : at[k + 1]]
                    if _class(_digest(raw.tobytes())) != (c1[i + k], c2[i + k]):
                        continue
                    n, mine = first[k + 1] - first[k], slice(found_at[i + k], found_at[i + k + 1])
                    step = np.bincount(np.clip(begins[mine], 0, n), minlength=n + 1) - np.bincount(np.clip(ends[mine], 0, n), minlength=n + 1)
                    stays = np.cumsum(step[:n]) == 0
                    place = np.append(start[first[k] : first[k + 1]], at[k + 1])
                    ink = np.concatenate([np.ones(place[0] - at[k], bool), np.repeat(stays, np.diff(place))])
                    text_kept = raw[ink].tobytes()
                    row.append(i + k)
                    removed.append(int((~stays).sum()))
                    sha.append(_digest(text_kept).hex())
                    kept.append(text_kept.decode("utf-8", "replace"))
            rows = pa.array(row, pa.int64())
            yield pa.record_batch([b.column(0).take(rows), b.column(1).take(rows), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["c1", "c2", "removed", "sha", "kept"])

    return texts.select("c1", "c2", "text", "begins", "ends").mapInArrow(run, "c1 long, c2 long, removed long, sha string, kept string")


EMPTY = hashlib.sha256(b"").hexdigest()


def remove_repeats(docs: DataFrame, span: int = 50, keep_text: bool = False) -> DataFrame:
    """Per row doc_id, n_words, n_removed, kept_sha256, of words under ``span``-word windows that repeat anywhere.

    With ``keep_text`` also kept: null where nothing was removed, else the text
    without the removed words and the blanks after them. kept_sha256 is of the kept words,
    joined by one space. Null and empty texts have no words; rows that repeat are
    copies of each other, and rows of one doc_id with different texts are documents of their own; a null doc_id stays
    null; an empty table gives an empty one; other columns are ignored.
    """
    bounded(docs.sparkSession)
    docs = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rows = written(profile(docs, span), "profile")
    # texts shorter than a window need no class; written, so that the join below stands alone in its stage and a class with very many copies can be split
    long = rows.where(F.col("n") >= span)
    classes = written(long.groupBy("c1", "c2").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "th")).alias("rep")), "classes")
    mine = F.struct("doc_id", "th").eqNullSafe(F.col("rep"))
    known = written(long.join(classes, ["c1", "c2"]).select("doc_id", "th", "c1", "c2", "n", "sha", "copies", F.when(mine, F.col("anchors")).alias("anchors")), "known")
    short = written(rows.where(F.col("n") < span).select("doc_id", "n", "sha"), "short")
    dropped(classes, rows)

    reps = known.where("anchors is not null")
    reps = reps.where("copies = 1").unionByName(reps.where("copies > 1").dropDuplicates(["c1", "c2"])).select("doc_id", "th", "c1", "c2", "copies", "anchors")
    entries = reps.select("doc_id", "th", "c1", "c2", "copies", F.explode("anchors").alias("anchor"))
    shared = written(entries.groupBy("anchor").agg(F.count("*").alias("many")).where("many > 1").select("anchor", (F.col("many") > TREE).alias("is_hot")), "shared")
    wanted = entries.join(shared, "anchor").groupBy("doc_id", "th", "c1", "c2", "copies").agg(F.collect_set("anchor").alias("shared"), F.collect_set(F.when(F.col("is_hot"), F.col("anchor"))).alias("hot"))
    wanted = written(wanted.withColumnRenamed("doc_id", "id").withColumnRenamed("th", "of"), "wanted")
    lean = written(known.select("doc_id", "c1", "c2", "n", "sha", "copies"), "known")
    dropped(shared, known)
    known = lean
    here = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("of"))
    leaves = written(suffixes(docs.join(wanted, here), span), "suffixes")

    # windows of hot anchors: a prefix of full depth that two suffixes share is a node; an anchor's nodes come in lists of bounded size
    nodes = written(leaves.where("w1 is not null").groupBy("hot", "w1", "w2").agg(F.sum("n").alias("many")).where("many > 1").select("hot", "w1", "w2"), "nodes")
    chunks = nodes.groupBy("hot").agg(F.ceil(F.count("*") / TREE).alias("chunks"))
    listed = nodes.join(chunks, "hot").groupBy("hot", F.pmod(F.xxhash64("w1", "w2"), F.col("chunks")).alias("chunk")).agg(F.collect_list(F.struct("w1", "w2")).alias("nodes"))
    listed = written(listed.select("hot", "nodes"), "listed")
    hits = F.filter(F.sequence(F.lit(0), F.size("ws") - 1), lambda i: F.array_contains("nodes", F.get("ws", i)))
    hot = leaves.where("ws is not null").join(listed, "hot").select("c1", "c2", "at", hits.alias("hits")).where(F.size("hits") > 0)
    # windows of one place overlap, so between the first and the last nothing stays
    hot = written(hot.select("c1", "c2", (F.col("at") + F.get("hits", F.lit(0))).alias("begin"), (F.col("at") + F.element_at("hits", -1) + span).alias("end")), "hot")
    # the other places of words that repeat in their own document
    spare = leaves.where("anchor is null and hot is null").select("c1", "c2", F.col("at").alias("begin"), F.col("until").alias("end"))
    once = wanted.where("copies = 1").select("id", "of", "c1", "c2")
    found = trees(leaves, span).unionByName(hot).unionByName(spare)
    found = found.groupBy("c1", "c2").agg(F.collect_set(F.struct("begin", "end")).alias("found"))
    found = written(once.join(found, ["c1", "c2"]).select("id", "of", "c1", "c2", F.col("found.begin").alias("begins"), F.col("found.end").alias("ends")), "found")
    dropped(leaves, nodes, listed, hot)
    after = written(cleaned(docs.join(found, here), span), "after")
    dropped(found, wanted)

    single = known.where("copies = 1").select("doc_id", "c1", "c2", "n", F.col("sha").alias("whole")).join(after, ["c1", "c2"], "left")
    kept = [F.col("kept")] if keep_text else []
    out = single.select("doc_id", F.col("n").alias("n_words"), F.coalesce("removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"), *kept)
    kept = [F.lit("").alias("kept")] if keep_text else []
    copied = known.where("copies > 1").select("doc_id", F.col("n").alias("n_words"), F.col("n").alias("n_removed"), F.lit(EMPTY).alias("kept_sha256"), *kept)
    kept = [F.lit(None).cast("string").alias("kept")] if keep_text else []
    short = short.select("doc_id", F.col("n").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), *kept)
    return out.unionByName(copied).unionByName(short)
