"""Operators on documents against brute force: encoding, lines, packing, similarity, passages, scores."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sigloom.llm import bpe, components, jaccard, lines, lmscore, packing, substrings, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"
CLASH = {"ids": "x", "lines": "y", "ends": "z", "k": "1", "key": "2", "n": "3", "part": "4", "component": "5", "rep": "6", "t": "7", "keep0": "8", "c1": "9"}


def docs(spark, texts, clash=False):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS) if not isinstance(texts, dict) else spark.createDataFrame(list(texts.items()), DOCS)
    return df.withColumns({c: F.lit(v) for c, v in CLASH.items()}) if clash else df


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = [None, "", " ", "  a \n b", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "it's we'll 'T", "\x1c x\x85 y", "日本語 é é 👩‍👩‍👧", "a" * 5000, "don't\n\n\n  stop ", "½ ²3 ١٢"]


def test_bpe_equals_the_library(spark, tokenizer):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab 'sTé\n\t .,1½日\x1c<|endoftext|>") for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["dup", "dup"]
    df = docs(spark, texts, clash=True)
    rows = {r["doc_id"]: r for r in bpe.round_trip(df, PATH).collect()}
    encoded = bpe.encode(df, PATH)
    ids = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, PATH).collect()}
    for i, t in enumerate(texts):
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert ids[i] == want and rows[i]["n_tokens"] == len(want)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert back[i] == tokenizer.decode(want, skip_special_tokens=False)
        assert rows[i]["decoded_sha256"] == hashlib.sha256(back[i].encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), PATH).count() == 0
    assert bpe.round_trip(spark.createDataFrame([(None, "a")], DOCS), PATH).first()["doc_id"] is None


def test_stale_entries_are_skipped():
    model = bpe.load_model(PATH)
    plain = {b: i for i, b in enumerate(model.strings)}

    def slow(word):
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            found = [(model.merges.get(plain[a] << 20 | plain[b], (1 << 30,))[0], i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(found)
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [plain[p] for p in parts]

    for word in (b"aaaaaaaa", b" thereabouts", b"mississippi", b"==========", "naïveté".encode()):
        assert bpe.merge_symbols([model.first[b] for b in word], model.merges) == slow(word)


def chunked(text):
    rows = (text or "").split("\n")
    h = [0, *(int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in rows)]
    roll = [0, *((a * lines.FACTOR + b) % lines.MODULUS for a, b in zip(h, h[1:]))]
    out, begin = [], 0
    for i in range(1, len(rows) + 1):
        if 2 <= i <= len(rows) - 2 and roll[i - 1] > roll[i] <= roll[i + 1] or i == len(rows):
            out.append(rows[begin:i])
            begin = i
    return out


def test_line_dedup_brute_force(spark):
    rng = random.Random(3)
    pool = [f"line {i}" for i in range(12)]
    texts = {i: "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for i in range(80)}
    long = lambda tag: "\n".join(f"{tag} {rng.random()}" for _ in range(rng.randint(3, 9)))
    passages = [long("passage") for _ in range(20)]
    texts |= {200 + i: "\n".join([long("own"), passages[i // 2], long("own")]) for i in range(40)}
    texts |= {100: None, 101: "", 102: "\n\n\n", 103: texts[5], 104: "long " * 20000 + "\n" + texts[5]}
    seen, want = set(), {}
    for i in sorted(texts):
        kept, gone = [], 0
        for c in chunked(texts[i]):
            if len(c) > 1 and "\n".join(c) in seen:
                gone += len(c)
            else:
                kept += c
            if len(c) > 1:
                seen.add("\n".join(c))
        want[i] = ((texts[i] or "").count("\n") + 1, gone, "\n".join(kept))
    out = lines.remove_repeated_chunks(docs(spark, texts, clash=True).repartition(3), keep=("lines", "k"))
    rows = out.collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept"]) for r in rows} == want
    assert {(r["lines"], r["k"]) for r in rows} == {("y", "1")} and any(w[1] for w in want.values())
    # of passages of 3 to 9 lines amid other text a third of the lines of the second copy go: a chunk that reaches over an edge stays
    assert sum(want[201 + 2 * i][1] for i in range(20)) > 0.3 * sum(p.count("\n") + 1 for p in passages)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
    assert lines.remove_repeated_chunks(docs(spark, {1: "a"}).limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "a\nb\nc\nd"), (7, "a\nb\nc\nd"), (7, "a\nb\nc\nd")], DOCS)
    kept = [(r["doc_id"], r["n_removed"]) for r in lines.remove_repeated_chunks(twice).collect()]
    assert (None, 0) in kept and len(kept) == 3


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("extra", [{}, {"documents": 5}, {"cost": 2500}])
def test_plan_is_what_placing_one_by_one_gives(rule, extra):
    limits = packing.Limits(tokens=64, rule=rule, **extra)
    rng = random.Random(4)
    lengths = sorted((rng.randint(1, 50) for _ in range(400)), reverse=True)
    full, weights = limits.vector, np.array(limits.weights) / limits.vector
    bins = []
    for n in lengths:
        piece = np.array([n, 1, n * n])
        fits = [b for b in bins if (b >= piece).all()]
        if not fits:
            fits = [full.copy()]
            bins += fits
        value = (lambda b: (((b - piece) * weights) ** 2).sum()) if rule == "norm" else (lambda b: -((b * weights) * (piece * weights)).sum())
        best = min(range(len(fits)), key=lambda i: (value(fits[i]), i))
        fits[best] -= piece
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows = packing.plan(counts, limits)
    length = np.array(lengths)
    rank = np.array([lengths[:i].count(n) for i, n in enumerate(lengths)])
    seq, off = packing.place(rows, length, rank)
    assert len(set(seq.tolist())) == len(bins)
    for s in set(seq.tolist()):
        mine = sorted(zip(off[seq == s].tolist(), length[seq == s].tolist()))
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]
        assert (sum(np.array([n, 1, n * n]) for _, n in mine) <= full).all()
    with pytest.raises(ValueError):
        packing.plan({65: 1}, limits)


def test_packing_of_documents(spark, tokenizer):
    rng = random.Random(6)
    texts = [*ODD, *(" ".join(rng.choice(("alpha", "beta", "gamma")) for _ in range(rng.randint(0, 300))) for _ in range(150)), "dup", "dup", "x y " * 9000]
    rows = packing.pack_documents(docs(spark, texts, clash=True).repartition(5), PATH).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    by = {}
    for r in rows:
        cut = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(cut) == r["length"] and zlib.crc32(cut.tobytes()) == r["ids_crc32"]
        assert r["piece"] == 0 or r["length"] == 1024
        by.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for i, pieces in by.items():
        pieces.sort()
        assert [p for p, _, _ in pieces] == list(range(len(pieces))) and sum(n for _, _, n in pieces) == len(ids[i])
    assert set(by) == set(ids)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert all(o == sum(n for _, n in p[:k]) for k, (o, _) in enumerate(p)) and sum(n for _, n in p) <= 1024
    assert len(places) <= -(-sum(map(len, ids.values())) // 1024) + 1
    assert packing.pack_documents(docs(spark, texts).limit(0), PATH).count() == 0


def test_packing_under_every_capacity(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choice(("alpha", "beta", "gamma")) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    limits = packing.Limits(tokens=128, documents=3, cost=4000, rule="dot")
    bound = {"tokens": 0, "documents": 0, "cost": 0}
    rows = packing.pack_documents(docs(spark, [t for t in texts if len(t.split()) < 40]), PATH, limits).collect()
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append(r["length"])
    for p in places.values():
        used = {"tokens": sum(p), "documents": len(p), "cost": sum(n * n for n in p)}
        assert used["tokens"] <= 128 and used["documents"] <= 3 and used["cost"] <= 4000
        bound = {k: max(bound[k], used[k]) for k in bound}
    assert bound["documents"] == 3 and bound["cost"] > 3000 and bound["tokens"] > 60


def shingles(text, size):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if len(ws) < size:
        return frozenset([tuple(ws)] if ws else [])
    return frozenset(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))


def union_find(ids, links):
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("size", "num", "block"), [(4, 85, 128), (5, 80, 3)])
def test_jaccard_join_brute_force(spark, monkeypatch, size, num, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice((3, 12, 60, 150)))] for _ in range(25)]
    shared = [rng.choice(vocabulary) for _ in range(30)]
    texts = {}
    for i in range(220):
        t = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 2, 6))):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        if rng.random() < 0.4:
            t += shared
        texts[i] = " ".join(t)
    texts |= {300: None, 301: "", 302: " \n", 303: "W1 w2", 304: "w1 W2", 305: "É w2", 306: "é w2", 307: "z " * 30000}
    sets = {i: shingles(t, size) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) and sets[b]]
    root = union_find(sets, links)
    rows = jaccard.near_duplicates(docs(spark, texts, clash=True).repartition(4), size, num, 100).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {i: (len(sets[i]), root[i]) for i in sets}
    assert len(set(root.values())) < len(root) - 50
    members, pairs = jaccard.similar_pairs(docs(spark, texts, clash=True).repartition(4), size, num, 100)
    rep = {r["doc_id"]: r["representative"] for r in members.collect()}
    firsts = {t: min(i for i in sets if sets[i] == t) for t in set(sets.values())}
    assert rep == {i: firsts[t] if t else i for i, t in sets.items()}
    got = sorted((r["a"], r["b"]) for r in pairs.collect())
    assert got == sorted((a, b) for a, b in links if rep[a] == a and rep[b] == b)
    assert len(got) > 20


def test_jaccard_join_of_sets_of_different_sizes(spark):
    texts = {}
    for i in range(200):  # the smallest member of the group is similar to neither of the other two
        q = [f"q{i}_{k}" for k in range(7)]
        texts |= {3 * i: " ".join(q + [f"h{i}_{k}" for k in range(6)]), 3 * i + 1: " ".join(q), 3 * i + 2: " ".join([*q, f"m{i}"])}
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs(spark, texts), 4, 80, 100).collect()}
    assert got == {d: d - (d % 3 == 2) for d in texts}


def test_jaccard_join_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (2, "p q r s t"), (9, "p q r s t")], DOCS)
    rows = sorted(((r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()), key=str)
    assert rows == sorted([(None, None), (4, 2), (2, 2), (2, 2), (2, 2), (9, 2)], key=str)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0
    members, pairs = jaccard.similar_pairs(df.limit(0))
    assert members.count() == pairs.count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    ids = list(range(400))
    rng.shuffle(ids)
    links = [*zip(ids[:150], ids[1:151]), *((ids[200], x) for x in ids[201:260]), *((rng.choice(ids[260:]), rng.choice(ids[260:])) for _ in range(60))]
    root = union_find(ids, links)
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root[i] for i in {x for a, b in links if a != b for x in (a, b)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("tree", [1, 4000])
def test_substring_dedup_brute_force(spark, monkeypatch, tree):
    monkeypatch.setattr(substrings, "TREE", tree)
    span, rng = 12, random.Random(tree)
    word = lambda: f"W{rng.randrange(5000)}"
    passages = [[word() for _ in range(rng.randint(8, 30))] for _ in range(6)]
    texts = {}
    for i in range(60):
        t = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(t))
            t[at:at] = rng.choice(passages)
        texts[i] = rng.choice((" ", "\n", "\t ")).join(t)
    texts |= {100: None, 101: "", 102: "same " * 400, 103: texts[7], 104: texts[8] + " end", 105: "one " * 5, 106: "é " * 20000}
    alone = lambda n: [word() for _ in range(n)]
    # a short phrase over and over, in less than a window: its place stands twice within reach of one window
    texts |= {107 + i: " ".join(alone(9) + ["u", "v"] * 5 + alone(9)) for i in range(2)} | {109: " ".join(passages[0] * 30 + alone(3))}
    split = {i: (t or "").encode().split() for i, t in texts.items()}
    count = {}
    for ws in split.values():
        for k in range(len(ws) - span + 1):
            count[tuple(ws[k : k + span])] = count.get(tuple(ws[k : k + span]), 0) + 1
    want = {}
    for i, ws in split.items():
        gone = set()
        for k in range(len(ws) - span + 1):
            if count[tuple(ws[k : k + span])] > 1:
                gone |= set(range(k, k + span))
        kept = [x for k, x in enumerate(ws) if k not in gone]
        want[i] = (len(ws), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept))
    rows = substrings.remove_repeats(docs(spark, texts, clash=True).repartition(3), span, keep_text=True).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == {i: w[:3] for i, w in want.items()}
    for r in rows:
        kept = texts[r["doc_id"]] if r["kept"] is None else r["kept"]
        assert b" ".join((kept or "").encode().split()) == want[r["doc_id"]][3] and (r["kept"] is None) == (r["n_removed"] == 0)
    odd = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (1, "q r s t u"), (1, "q r s t"), (2, None)], DOCS)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(odd, 4).collect())
    assert got == [("1", 4, 4), ("1", 5, 4), ("2", 0, 0), ("None", 4, 4), ("None", 4, 4)]
    assert substrings.remove_repeats(odd.limit(0), 4).count() == 0


def thue_morse(n, swap=False):
    return "".join("ab"[bin(i).count("1") & 1 ^ swap] for i in range(n))


@pytest.mark.parametrize("size", [1024, 2048])
def test_balanced_patterns_do_not_collide(spark, size):
    one, two = thue_morse(size), thue_morse(size, True)
    texts = {1: one, 2: two, 3: " ".join(one), 4: " ".join(two)}
    rows = jaccard.near_duplicates(docs(spark, {1: one, 2: two})).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {1: 1, 2: 2}
    kept = [" ".join(f"w{k}x{i}" for k in range(6)) for i in range(4)]
    rows = substrings.remove_repeats(docs(spark, {1: f"{kept[0]} q {one} z {kept[1]}", 2: f"{kept[2]} q {two} z {kept[3]}"}), 5).collect()
    assert [r["n_removed"] for r in rows] == [0, 0]
    hashes = {i: words.word_hashes(*words.texts(pa.array([t]))[:1], *words.words(*words.texts(pa.array([t])))[:2]) for i, t in texts.items()}
    assert hashes[1] != hashes[2] and words.grams(hashes[3], size) != words.grams(hashes[4], size)


def test_words_of_long_texts(monkeypatch):
    text = "\n".join(" x" * (i % 7) + "y" * i for i in range(90))
    want = words.words(*words.texts(pa.array([text, "z", text])))
    monkeypatch.setattr(words, "PIECE", 64)
    monkeypatch.setattr(words, "WORDS", 16)
    got = words.words(*words.texts(pa.array([text, "z", text])))
    assert all((x == y).all() for x, y in zip(want, got))


def test_maximal_repeats_of_a_tree():
    # one tree, anchor at place 2: rows 0 and 1 share places 1 to 6, rows 1 and 2 places 2 to 6
    ids = np.array([[1, 2, 3, 4, 5, 6, 7], [8, 2, 3, 4, 5, 6, 9], [10, 11, 3, 4, 5, 6, 12], [13, 14, 15, 16, 17, 18, 19]])
    row, begin, end = substrings.repeats(np.array([1, 1, 1, 1]), ids, np.full(4, 2), np.full(4, 5), 2, 4)
    assert sorted(zip(row.tolist(), begin.tolist(), end.tolist())) == [(0, 1, 6), (1, 1, 6), (2, 2, 6)]
    row, _, _ = substrings.repeats(np.array([1, 2, 3, 4]), ids, np.full(4, 2), np.full(4, 5), 2, 4)
    assert not len(row)


def test_word_hashes_follow_words_alone():
    rng = random.Random(9)
    texts = ["", None, " a  b ", "A b", *("".join(rng.choice("aAbé \n\t\x0b\x1c ") for _ in range(rng.randint(0, 30))) for _ in range(300))]
    seen = {}
    for i, j, data, at in words.blocks(pa.array(texts).slice(1)):
        start, stop, first = words.words(data, at)
        h = words.word_hashes(data, start, stop, fold=True)
        for k in range(j - i):
            want = [m.group() for m in re.finditer(rb"[^\x20\x09-\x0d]+", (texts[1 + i + k] or "").encode())]
            assert want == [bytes(data[x:y]) for x, y in zip(start[first[k] : first[k + 1]], stop[first[k] : first[k + 1]])]
            for g, x in zip(want, h[first[k] : first[k + 1]]):
                assert seen.setdefault(re.sub(rb"[A-Z]", lambda m: m.group().lower(), g), x) == x
    assert len(set(seen.values())) == len(seen)


def test_language_model_scores_brute_force(spark):
    rng = random.Random(11)
    texts = {i: " ".join(rng.choice("the cat sat on a mat rarely".split() if i % 2 else "zig zag zog the".split()) for _ in range(rng.randint(1, 30))) for i in range(40)}
    texts |= {50: None, 51: "", 52: "The CAT unseenword", 53: texts[1]}
    target = [i for i in texts if i % 2 and i < 50]
    tokens = {i: re.sub("[A-Z]", lambda m: m.group().lower(), t or "").split() for i, t in texts.items()}
    models = lmscore.fit(docs(spark, texts, clash=True), spark.createDataFrame([(i,) for i in target], "doc_id long"))
    got = {r["doc_id"]: r for r in lmscore.score(docs(spark, texts, clash=True), models).collect()}
    one, two, vocabulary = ({}, {}), ({}, {}), set()
    for i, ws in tokens.items():
        vocabulary |= set(ws)
        for k, use in enumerate((i in target, True)):
            for w_ in ws if use else ():
                one[k][w_] = one[k].get(w_, 0) + 1
            for p in zip(ws, ws[1:]) if use else ():
                two[k][p] = two[k].get(p, 0) + 1
    listed = [p for p, n in two[1].items() if n > 1]
    size = len(vocabulary) + lmscore.LENGTHS

    def uni(k, x):
        return (one[k].get(x, 0) + 0.5) / (sum(one[k].values()) + 0.5 * size)

    def probability(k, a, b):
        following = sum(two[k].get(p, 0) for p in listed if p[0] == a)
        total = max(one[k].get(a, 0), following) + 1
        back = (1 - following / total) * uni(k, b)
        bi = max(two[k].get((a, b), 0) / total, back) if (a, b) in listed else back
        return 0.4 * uni(k, b) + 0.6 * bi

    for i, ws in tokens.items():
        gain = [np.log2(uni(0, x)) - np.log2(uni(1, x)) if not n else np.log2(probability(0, ws[n - 1], x)) - np.log2(probability(1, ws[n - 1], x)) for n, x in enumerate(ws)]
        assert got[i]["n_tokens"] == len(ws)
        assert abs(got[i]["score"] - (np.mean(gain) if gain else 0)) < 1e-4
    assert got[1]["score"] > got[0]["score"]
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    want = {r["doc_id"]: (r["n_tokens"], r["score"]) for r in lmscore.score(docs(spark, texts), lmscore.fit(docs(spark, texts), ids, least=1)).collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["score"]) for r in lmscore.score_corpus(docs(spark, texts, clash=True).repartition(3), ids).collect()}
    assert got.keys() == want.keys() and all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-9 for i in want)
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), *((7, f"the cat {i}") for i in range(50))], DOCS)
    pairs = [sorted((str(r["doc_id"]), round(r["score"], 9)) for r in f.collect()) for f in (lmscore.score(odd, lmscore.fit(odd, ids, least=1)), lmscore.score_corpus(odd, ids))]
    assert pairs[0] == pairs[1] and len(pairs[0]) == 52
    empty = docs(spark, {1: "a"}).limit(0)
    assert lmscore.score_corpus(empty, empty.select("doc_id")).count() == 0
    assert lmscore.score(empty, lmscore.fit(empty, empty.select("doc_id"))).count() == 0


@pytest.mark.parametrize("least", [1, 2])
def test_language_models_keep_all_words_and_bigrams(spark, monkeypatch, least):
    # 70,000 words and 1.2 million bigrams; without copies nearly all bigrams occur once
    rng = np.random.default_rng(5)
    drawn = rng.integers(0, 70_000, (600, 2000))
    drawn[:35] = rng.permutation(70_000).reshape(35, 2000)
    texts = {i: " ".join(f"w{x}" for x in row) for i, row in enumerate(drawn)}
    copies = 2 if least == 2 else 1
    every = {i + 1000 * c: t for i, t in texts.items() for c in range(copies)}
    target = [i for i in every if i % 3 == 0]
    models = lmscore.fit(docs(spark, every), spark.createDataFrame([(i,) for i in target], "doc_id long"), **({"least": 1} if least == 1 else {}))
    monkeypatch.setattr(lmscore, "BLOCK", 1 << 21)
    got = {r["doc_id"]: r["score"] for r in lmscore.score(docs(spark, every), models).collect()}
    if least == 1:
        again = {r["doc_id"]: r["score"] for r in lmscore.score_corpus(docs(spark, every), spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
        assert all(abs(again[i] - got[i]) < 1e-9 for i in got)
    weight = np.array([[sum(j in set(target) for j in (i, i + 1000)[:copies]), copies] for i in range(600)])
    count, inner = np.zeros((70_000, 2)), np.zeros((70_000, 2))
    pair = drawn[:, :-1] * 70_000 + drawn[:, 1:]
    keys, place = np.unique(pair, return_inverse=True)
    place = place.reshape(pair.shape)
    two = np.column_stack([np.bincount(place.ravel(), np.repeat(weight[:, k], 1999)) for k in (0, 1)])
    for k in (0, 1):
        np.add.at(count[:, k], drawn.ravel(), np.repeat(weight[:, k], 2000))
        np.add.at(inner[:, k], drawn[:, :-1].ravel(), np.repeat(weight[:, k], 1999))
    assert len(count) > 1 << 16 and len(keys) > 1 << 20
    uni = (count + 0.5) / (count.sum(axis=0) + 0.5 * (70_000 + lmscore.LENGTHS))
    for i in range(0, 600, 7):
        a, b = drawn[i, :-1], drawn[i, 1:]
        p = 0.4 * uni[b] + 0.6 * np.maximum(two[place[i]] / (count[a] + 1), (1 - inner[a] / (count[a] + 1)) * uni[b])
        gain = np.diff(np.log2(np.concatenate([uni[drawn[i, :1]], p]))[:, ::-1], axis=1)
        assert abs(got[i] - gain.mean()) < 1e-6
