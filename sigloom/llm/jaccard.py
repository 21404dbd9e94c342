"""Operator 7: exact Jaccard self-join of documents' word n-grams by a token-group matrix.

A document's tokens are the hashes of its distinct n-grams, in one global order:
tokens that weigh more than a fixed share of the corpus last, else by hash. Only a
document's first ``n - required + 1`` tokens can be the first that it shares with a
partner, so these make the matrix of tokens and groups. Documents that share such
a token form a group (in blocks of bounded size); a group holds the union of its
members' leading tokens. A query document's overlap with a group is bounded by
what it shares with the union plus what neither has listed; only groups whose
bound reaches the required overlap are opened, and members are bounded alike
before the exact check on whole token sets.

Equal sets are one class from the start. A first round links each class with its
groups' smallest members only; classes that these links connect need no further
comparing, so a group of near copies costs its size and not its square.
That gives components; :func:`similar_pairs` skips this round and gives every link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import words as w
from sigloom.llm.components import components
from sigloom.llm.grouping import lists, runs
from sigloom.llm.shared import bounded, dropped, written

#: A token is weighty when it makes up more than this share of all; so there are 2**18 of them at most.
WEIGHTY = 18
#: Tokens counted together before only those seen this often are passed on.
TALLY, SEEN = 2_000_000, 3
BLOCK = 128
SIEVE = 1 << 24
#: So many of a document's leading tokens, evenly spaced, tell how many lie below a given one.
MARKS = 16
LEVELS = 31
#: Columns of a group's union compared at once.
COLUMNS = 4096


def token_sets(column: pa.Array, size: int):
    """For each block of texts: (first row, tokens sorted within each text, text of each, texts)."""
    for i, j, data, at in w.blocks(column):
        start, stop, first = w.words(data, at)
        hashes = w.word_hashes(data, start, stop, fold=True)
        begin, text = w.windows(first, size)
        n = np.diff(first)
        found, of = [w.grams(hashes, size)[begin]], [text]
        for m in range(1, size):  # a shorter text is one n-gram
            short = np.flatnonzero(n == m)
            found.append(w.grams(hashes, m)[first[short]])
            of.append(short)
        token, text = np.concatenate(found), np.concatenate(of)
        order = np.lexsort((token, text))
        token, text = token[order], text[order]
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
        yield i, token[keep], text[keep], j - i


def weighty(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The weighty tokens, sorted, and their levels (each double the last).

    Counts whole texts of all documents; a token that is rare in every run of
    TALLY tokens may be missed, which costs speed alone.
    """

    def run(batches):
        held, many, total = [], 0, 0

        def tally():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= SEEN
            return pa.record_batch([pa.array(token[often].view(np.int64)), pa.array(n[often])], names=["token", "n"])

        for b in batches:
            for _, token, _, _ in token_sets(b.column(0), size):
                held.append(token)
                many += len(token)
                total += len(token)
                if many >= TALLY:
                    yield tally()
                    held, many = [], 0
        if held:
            yield tally()
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([total])], names=["token", "n"])

    counted = written(docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "tally")
    total = counted.where("token is null").agg(F.sum("n")).first()[0] or 0
    least = max(32, total >> WEIGHTY)
    heavy = counted.where(F.col("token").isNotNull() & (F.col("n") >= least)).toArrow()
    token, n = heavy["token"].to_numpy().view(np.uint64), heavy["n"].to_numpy()
    order = np.argsort(token)
    return token[order], np.minimum(LEVELS, 1 + np.log2(np.maximum(n[order], 1) / least)).astype(np.uint64)


def required(n: int | np.ndarray, m: int | np.ndarray, num: int, den: int):
    """The least overlap of sets of n and m tokens with Jaccard similarity num / den."""
    return -(-num * (n + m) // (num + den))


def leading(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Per row doc_id, n, two digests of the token set, and its leading tokens in order."""
    heavy, level = weighty(docs, size)
    shared = docs.sparkSession.sparkContext.broadcast((heavy, level))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        heavy, level = shared.value
        for b in batches:
            for i, token, text, many in token_sets(b.column(1), size):
                n = np.bincount(text, minlength=many)
                begin = np.cumsum(n) - n
                some = n > 0
                one, two = np.zeros(many, np.uint64), np.zeros(many, np.uint64)
                if len(token):
                    one[some] = np.add.reduceat(w.mix(token), begin[some])
                    two[some] = np.bitwise_xor.reduceat(w.mix(token + w.U(0x632BE59BD9B4E019)), begin[some])
                key = token >> w.U(5)
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, token), len(heavy) - 1)
                    key |= np.where(heavy[at] == token, level[at], w.U(0)) << w.U(59)
                order = np.lexsort((key, text))
                take = np.where(some, n + (-num * n // den) + 1, 0)
                place = np.arange(len(key)) - np.repeat(begin, n)
                chosen = key[order][place < np.repeat(take, n)].view(np.int64)
                yield pa.record_batch([b.column(0).slice(i, many), pa.array(n, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]), pa.int32()), pa.array(chosen))], names=["doc_id", "n", "s1", "s2", "lead"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, lead array<long>")


def beyond(n: np.ndarray, many: np.ndarray, marks: np.ndarray, last: np.ndarray) -> np.ndarray:
    """At most so many of a document's n tokens come after ``last``; it has ``many`` leading ones and their marks."""
    below = (marks <= last[..., None]).sum(axis=-1)
    return n - -(-below * many // MARKS)


class Documents:
    """A batch's columns n, many, shared (31 bits of the leading tokens that others have too) and marks, for bounding pairs."""

    def __init__(self, table: pa.Table | pa.RecordBatch, suffix: str = ""):
        self.n, self.many = (table.column(k + suffix).to_numpy() for k in ("n", "many"))
        self.values, self.at = lists(table.column("shared" + suffix))
        self.marks = lists(table.column("marks" + suffix))[0].view(np.uint64).reshape(-1, MARKS)

    def owner(self) -> np.ndarray:
        """The row of each of ``values``."""
        return np.repeat(np.arange(len(self.n)), np.diff(self.at))

    def rest(self, rows: np.ndarray, other: Documents, theirs: np.ndarray) -> np.ndarray:
        """What rows and theirs (broadcast against each other) can share at most of the tokens that one of them has not listed."""
        last = np.minimum(self.marks[rows, -1], other.marks[theirs, -1])
        return np.minimum(beyond(self.n[rows], self.many[rows], self.marks[rows], last), beyond(other.n[theirs], other.many[theirs], other.marks[theirs], last))


def overlaps(d: Documents, queries: np.ndarray, members: np.ndarray, owner: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
    """How many tokens each query shares with each member, by columns of the union, a bounded number at once."""
    out = np.zeros((len(queries), len(members)), np.float32)
    row_q, row_m = np.full(len(d.n), -1), np.full(len(d.n), -1)
    row_q[queries], row_m[members] = np.arange(len(queries)), np.arange(len(members))
    for x in range(0, width, COLUMNS):
        some = (column >= x) & (column < x + COLUMNS)
        sides = []
        for rows, many in ((row_q, len(queries)), (row_m, len(members))):
            mine = some & (rows[owner] >= 0)
            side = np.zeros((many, min(COLUMNS, width - x)), np.float32)
            side[rows[owner[mine]], column[mine] - x] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def open_groups(group: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of documents in one group whose bounds allow a link.

    ``group`` has token, i, j (two blocks of the token's group, i <= j), block,
    doc, comp, early (whether the token is an early one of its) and what :class:`Documents` takes; it is dealt and sorted by token, i, j here.
    """

    def run(batches):
        for g in runs(batches, ["token", "i", "j"]):
            doc, comp, block = (g[c].to_numpy() for c in ("doc", "comp", "block"))
            early = g["early"].to_numpy()
            i, j = g["i"][0].as_py(), g["j"][0].as_py()
            d = Documents(g)
            members = np.flatnonzero(block == i)
            queries = members if i == j else np.flatnonzero(block == j)
            if not len(members) or not len(queries):
                continue
            q, m = queries[:, None], members[None, :]
            fits = (den * np.minimum(d.n[q], d.n[m]) >= num * np.maximum(d.n[q], d.n[m])) & (comp[q] != comp[m])
            fits &= (early[q] & (d.n[q] <= d.n[m])) | (early[m] & (d.n[q] >= d.n[m]))
            if i == j:
                fits &= doc[m] < doc[q]
            if not fits.any():
                continue
            owner = d.owner()
            union = np.unique(d.values[np.isin(owner, members)])
            column = np.minimum(np.searchsorted(union, d.values), len(union) - 1)
            column = np.where(union[column] == d.values, column, -1)
            rest, least = d.rest(q, d, m), required(d.n[q], d.n[m], num, den)
            # the group's bound: no member shares more than the union does
            shared = np.bincount(owner[column >= 0], minlength=len(d.n))[queries]
            opened = (fits & (shared[:, None] + rest >= least)).any(axis=1)
            if not opened.any():
                continue
            common = overlaps(d, queries[opened], members, owner, column, len(union))
            x, y = np.nonzero(fits[opened] & (common + rest[opened] >= least[opened]))
            a, b = doc[queries[opened][x]], doc[members[y]]
            if len(a):
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    dealt = group.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def allowed(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose bound allows a link, of pairs with both documents' columns, those of b with _b."""

    def run(batches):
        for t in batches:
            if not t.num_rows:
                continue
            x, y, rows = Documents(t), Documents(t, "_b"), np.arange(t.num_rows)
            ours, theirs = (d.owner() << 32 | d.values.astype(np.int64) for d in (x, y))
            common = np.bincount(x.owner()[np.isin(ours, theirs)], minlength=len(rows))
            keep = common + x.rest(rows, y, rows) >= required(x.n, y.n, num, den)
            yield t.select(["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a long, b long")


def _bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of SIEVE bits with those of all ids set: of fixed size, so it can be broadcast whatever their number."""
    h = F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE))
    rows = ids.select(F.shiftright(h, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {SIEVE}L) & 63 as int))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(SIEVE >> 6, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def slices(sizes: np.ndarray, most: int = 1 << 18):
    """Runs (begin, end) of rows whose sizes sum up to ``most``, or of one row."""
    total, begin = np.concatenate([[0], np.cumsum(sizes)]), 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + most, "right")) - 1)
        yield begin, end
        begin = end


def verified(pairs: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Those of the written pairs (a, b) whose whole token sets have the similarity.

    Texts stay where they are: a bitmap of the ids in pairs lets most others
    go, those that slip through are left out by the joins, and only token sets are shuffled.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    wanted = docs.sparkSession.sparkContext.broadcast(_bits(ids))

    def sets(batches):
        for b in batches:
            h = b.column(2).to_numpy().astype(np.uint64)
            keep = (wanted.value[(h >> w.U(6)).astype(np.int64)] >> (h & w.U(63))) & w.U(1) > 0
            b = b.filter(pa.array(keep))
            for i, token, text, many in token_sets(b.column(1), size):
                at = np.searchsorted(text, np.arange(many + 1))
                yield pa.record_batch([b.column(0).slice(i, many), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(token.view(np.int64)))], names=["doc_id", "tokens"])

    def check(batches):
        for b in batches:
            (x, xa), (y, ya) = lists(b.column("x")), lists(b.column("y"))
            keep = np.zeros(b.num_rows, bool)
            for begin, end in slices(np.diff(xa) + np.diff(ya)):
                n = np.diff(xa[begin : end + 1]) + np.diff(ya[begin : end + 1])
                token = np.concatenate([x[xa[begin] : xa[end]], y[ya[begin] : ya[end]]])
                of = np.concatenate([np.repeat(np.arange(end - begin), np.diff(at[begin : end + 1])) for at in (xa, ya)])
                order = np.lexsort((token, of))
                token, of = token[order], of[order]
                # either set has a token once
                same = np.bincount(of[1:][(token[1:] == token[:-1]) & (of[1:] == of[:-1])], minlength=end - begin)
                keep[begin:end] = (same > 0) & (den * same >= num * (n - same))
            yield pa.record_batch([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))

    rows = docs.where("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE)).alias("h"))
    full = written(rows.mapInArrow(sets, "doc_id long, tokens array<long>"), "sets")
    left, right = full.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x")), full.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _matrix(docs: DataFrame, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables of all documents (doc_id, n, rep), the matrix of shared tokens and class representatives, and what bounds need of each representative."""
    rows = written(leading(docs, size, num, den), "lead")
    sets = rows.where("n > 0 and doc_id is not null")
    classes = written(sets.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    same = sets.join(classes, ["n", "s1", "s2"])
    members = written(same.select("doc_id", "n", "rep").unionByName(rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("rep"))), "members")
    reps = written(same.where("doc_id = rep").select(F.col("rep").alias("doc"), "n", "lead"), "reps")
    dropped(rows, classes)

    # of two linked sets the smaller shows a common token this early, the larger within all its leading ones
    early = F.col("n") - F.floor((2 * num * F.col("n") + num + den - 1) / (num + den)) + 1
    entries = reps.select("doc", "n", early.alias("until"), F.posexplode("lead").alias("place", "token")).select("token", "doc", "n", (F.col("place") < F.col("until")).alias("early"))
    tokens = entries.groupBy("token").agg(F.count("*").alias("group"), F.min(F.struct("doc", "n", "early")).alias("hub"), F.bool_or("early").alias("any")).where("group > 1")
    tokens = written(tokens, "tokens")
    matrix = written(entries.join(tokens, "token").select("token", "doc", "n", "early", "group", "hub", "any"), "matrix")
    dropped(tokens)

    marks = F.transform(F.sequence(F.lit(1), F.lit(MARKS)), lambda i: F.get("lead", (F.ceil(i * F.size("lead") / MARKS) - 1).cast("int")))
    shared = matrix.groupBy("doc").agg(F.collect_list(F.col("token").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("shared"))
    brief = written(reps.select("doc", "n", F.size("lead").cast("long").alias("many"), marks.alias("marks")).join(shared, "doc"), "brief")
    dropped(reps)
    return members, matrix, brief


def _blocks(active: DataFrame, brief: DataFrame) -> DataFrame:
    """What :func:`open_groups` takes, of rows (token, doc, early, group, comp): each group in blocks, each pair of them together once."""
    blocks = F.ceil(F.col("group") / BLOCK).cast("int")
    active = active.select("token", "doc", "early", "comp", blocks.alias("blocks"), F.pmod(F.xxhash64("doc"), blocks).cast("int").alias("block"))
    active = active.join(brief, "doc").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return active.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc", "early", "comp", "n", "many", "shared", "marks")


def similar_pairs(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """Every link between different sets: (members, links).

    members has doc_id, n_shingles and representative, the smallest doc_id with an equal set (null
    for a null doc_id); links has the pairs (a, b), a < b, of representatives whose sets have similarity
    num / den or more. Documents of one representative link with each other and with all that it links with,
    but for those without words, which link with nothing. No group is settled beforehand
    here, so the work grows with the links there are. Rows, null and empty texts, repeats, empty tables
    and other columns are taken as :func:`near_duplicates` takes them.
    """
    bounded(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members, matrix, brief = _matrix(docs, size, num, den)
    found = written(open_groups(_blocks(matrix.where("any").withColumn("comp", F.col("doc")), brief), num, den), "pairs")
    dropped(matrix, brief)
    links = written(verified(found, docs, size, num, den).distinct(), "links")
    return members.select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("representative")), links


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row doc_id, n_shingles and component_id, of links with Jaccard similarity num / den or more.

    Words are lower-cased in A-Z only. A text of fewer than ``size`` words counts as one
    n-gram, an empty or null one as none, linked with nothing. Rows that
    repeat a doc_id are one document. A null doc_id stays null, with a null
    component, and links with nothing. An empty table gives an empty one; other
    columns are ignored.
    """
    bounded(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members, matrix, brief = _matrix(docs, size, num, den)
    near = F.lit(den) * F.least("n", "hub.n") >= F.lit(num) * F.greatest("n", "hub.n")
    shown = F.when(F.col("n") < F.col("hub.n"), F.col("early")).when(F.col("n") > F.col("hub.n"), F.col("hub.early")).otherwise(F.col("early") | F.col("hub.early"))
    hubs = matrix.where(near & shown & (F.col("doc") != F.col("hub.doc"))).select(F.col("hub.doc").alias("a"), F.col("doc").alias("b")).distinct()
    both = hubs.join(brief.withColumnRenamed("doc", "a"), "a").join(brief.select(F.col("doc").alias("b"), *(F.col(c).alias(f"{c}_b") for c in brief.columns if c != "doc")), "b")
    links = written(verified(written(allowed(both, num, den), "pairs"), docs, size, num, den), "links")
    joined = components(links)

    # groups of two were compared in full with their smallest members
    known = matrix.where("any and group > 2").join(joined.withColumnRenamed("id", "doc"), "doc", "left").select("token", "doc", "early", "group", F.coalesce("component", "doc").alias("comp"))
    known = written(known, "known")
    dropped(matrix)
    open_ = known.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("token")
    active = known.join(open_, "token").select("token", "doc", "early", "group", "comp")
    found = written(open_groups(_blocks(active, brief), num, den), "pairs")
    dropped(brief, known)
    more = written(verified(found, docs, size, num, den), "links")

    linked = components(links.unionByName(more)).withColumnRenamed("id", "rep")
    return members.join(linked, "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
