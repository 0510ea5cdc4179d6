"""Corpus operators: awkward rows, brute force and exact round trips."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import context_tree, html_text, metric_tree, minhash, mixing, packing, quality, suffix_dedup, tokens, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 131}" for i in range(30_000))
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "b", 0),
    (3, " \t\n", "en", "a", 3),
    (4, "one", "en", "a", 3),
    (4, "one", "en", "a", 3),
    (None, "no id here at all", "en", "a", 17),
    (5, "Ünï cödé — 世界 \U0001f600 " * 9, "de", "é", 1),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + " tail", "en", None, 1),
    (8, "a\x00b c\x0bd", "en", "b", 1),
    (9, "same line\nsame line\nother # * line $ % & | < >", "en", "b", 1),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Awkward rows with extra columns whose names the operators use themselves."""
    extra = {c: F.lit(7) for c in ("size", "target", "keys", "component", "rep", "copy", "digest", "batch", "range", "kind", "length", "start", "score", "at", "n", "e", "words")}
    return spark.createDataFrame(AWKWARD, SCHEMA).withColumns(extra)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def counts(t):
    t = t or ""
    w = words(t)
    tri = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {j for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if tri[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_quality_counts_and_verdict(awkward, empty, spark):
    got = quality.judge(awkward).select("text", "quality.*", "kept").collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts(r["text"])
    assert not any(r["kept"] for r in got if r["n_words"] < 50)
    assert quality.judge(empty).count() == 0
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab c\nd the of".split(" ")) for _ in range(rng.randrange(90))) for _ in range(60)]
    for r in quality.judge(spark.createDataFrame([(t,) for t in texts], "text string")).select("text", "quality.*").collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts(r["text"])
    assert quality.keep_good(awkward).columns == awkward.columns


def test_mixing(awkward, empty, spark):
    got = mixing.taken_words(awkward).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(r["size"] for r in got) == sorted(len(words(t[1])) for t in AWKWARD)
    assert mixing.taken_words(empty).count() == 0
    again = mixing.taken_words(awkward).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    rows = [(i, "w " * (1 + i % 9), None, "abc"[i % 3] if i % 10 else "a", 1) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    by = df.select("doc_id", "source").join(mixing.taken_words(df, block_words=16), "doc_id").groupBy("source").agg(F.sum("taken").alias("took"), F.first("target").alias("t"), F.sum("size").alias("s")).collect()
    assert all(abs(r["took"] - r["t"]) <= 1 and r["t"] <= 2 * r["s"] for r in by)
    assert abs(sum(r["t"] for r in by) - 1.5 * sum(r["s"] for r in by)) < 1e-6


def test_mixing_targets_are_filled_up(spark):
    sums = spark.createDataFrame([("=a", "a", 1000), ("=b", "b", 10), ("=c", "c", 10), ("null", None, 0)], "src_key string, source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sums).collect()}
    assert got == {"a": 1490.0, "b": 20.0, "c": 20.0, None: 0.0}


def test_schedule_is_even(spark):
    t = spark.createDataFrame([("=a", 300), ("=b", 100), ("=c", 200)], "src_key string, need long")
    rows = mixing.schedule(t, 600, 1).orderBy("slot").collect()
    assert sorted((r["src_key"], r["rank"]) for r in rows) == [(k, i) for k, n in (("=a", 300), ("=b", 100), ("=c", 200)) for i in range(n)]
    half = collections.Counter(r["src_key"] for r in rows[:300])
    assert abs(half["=a"] - 150) <= 4 and abs(half["=b"] - 50) <= 4 and abs(half["=c"] - 100) <= 4


def test_packing_round_trip(awkward, empty):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokens.default_path())
    pieces = packing.pack(awkward.coalesce(2)).collect()
    whole, used = collections.Counter(), collections.defaultdict(int)
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for doc, text, *_ in AWKWARD:
        whole[doc, np.array([*slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()] += 1
    for (doc, ids), n in whole.items():
        mine = [p for p in by_doc[doc] if p["doc_tokens"] * 4 == len(ids)]
        assert sorted((p["start"], bytes(p["ids"])) for p in mine) == sorted(n * [(p["start"], ids[4 * p["start"] : 4 * (p["start"] + p["length"])]) for p in {q["start"]: q for q in mine}.values()])
        assert sum(p["length"] for p in mine) * 4 == n * len(ids)
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0
    assert packing.pack(empty).count() == 0 and not used


def test_harmonic_bins():
    rng = random.Random(3)
    for lengths in ([rng.choice((1, 3, 17, 200, 340, 341, 342, 511, 512, 513, 700, 1023, 1024, 1025, 5000)) for _ in range(3000)], [int(rng.expovariate(1 / 600)) + 1 for _ in range(3000)], [600] * 400, [1], [5]):
        bins, docs = packing.Bins(1024, 0), []
        for i, n in enumerate(lengths):
            docs.append(np.arange(i, i + n, dtype="<u4").tobytes())
            bins.add((i, 0, n, docs[-1], n))
        bins.finish()
        sequences, mine = collections.defaultdict(list), collections.defaultdict(list)
        for p in bins.done:
            sequences[p[5]].append((p[6], p[2]))
            mine[p[0]].append((p[1], p[2], p[3], p[4]))
        for i, n in enumerate(lengths):
            at = 0
            for start, length, ids, total in sorted(mine[i]):
                assert start == at and ids == docs[i][4 * at : 4 * (at + length)] and total == n
                at += length
            assert at == n
        short = []
        for pieces in sequences.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at and length
                at += length
            assert at == 1024 or at & (at - 1) == 0
            short += [at] * (at < 1024)
        assert len(short) <= 10 and len(sequences) <= sum(lengths) // 1024 + 10
        full = sum(n // 1024 for n in lengths)
        assert len(bins.done) <= len(lengths) + full + 2 * len(sequences)


def test_special_strings_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    e, slow = tokens.Encoder(tokens.default_path()), Tokenizer.from_file(tokens.default_path())
    for t in ("a<|endoftext|>b", "plain  text\n\n x", "ñ" * 50, "'ll we've 123"):
        assert e.ids(t).tolist() == slow.encode(t, add_special_tokens=False).ids
    assert e.fast is not None


def jaccard_classes(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(zip(*(w[j:] for j in range(k)), strict=False)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_minhash_against_brute_force(spark, awkward, empty):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 14)):
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice((0, 0.02, 0.05, 0.09)) else w for w in base]
            rows.append((len(rows) * 3 + 1, " ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
    rng.shuffle(rows)
    want, sizes = jaccard_classes(rows, 2, 80)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    odd = minhash.near_duplicates(awkward, k=2).collect()
    assert len(odd) == len(AWKWARD)
    by = {r["doc_id"]: r for r in odd}
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0 and by[3]["component_id"] == 3
    assert by[7]["component_id"] == 6 and by[None]["component_id"] is None
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.keep_one(awkward)
    assert kept.columns == awkward.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "8", "9", "None"]


def test_rows_of_one_id_are_documents_of_their_own(spark):
    base = [f"v{i}" for i in range(60)]
    other = [f"u{i}" for i in range(60)]
    near = [*base[:-1], "new"]
    rows = [(5, " ".join(other)), (5, " ".join(base)), (3, " ".join(near)), (None, " ".join(base)), (None, " ".join(other).upper()), (None, "only here no id"), (None, "only here no id"), (None, None), (None, None), (9, ""), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(df, k=2).collect()), key=str)
    assert got == sorted([(5, 5), (5, 3), (3, 3), (None, 3), (None, 5), (None, None), (None, None), (None, None), (None, None), (9, 9), (9, 9)], key=str)
    kept = sorted(map(tuple, minhash.keep_one(df, k=2).collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[5], rows[7], rows[8], rows[9], rows[10]], key=str)


def test_frequent_elements_do_not_change_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FREQUENT", 3)
    rng = random.Random(11)
    common = [f"c{i}" for i in range(30)]
    rows = []
    for family in range(20):
        own = [f"f{family}w{i}" for i in range(rng.randint(4, 12))]
        for _ in range(4):
            rows.append((len(rows), " ".join(w for w in common + own if rng.random() > 0.06)))
    want, _ = jaccard_classes(rows, 2, 80)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2, pivots=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for n, common in ((3, 2), (60, 45), (900, 800)):
        share = []
        for _ in range(60):
            z = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
            share.append((minhash.sketch(z[:n], 288) == minhash.sketch(z[n - common :], 288)).mean())
        assert abs(np.mean(share) - common / (2 * n - common)) < 0.06


def brute_repeats(docs, length=50):
    first = {}
    for i, b in docs:
        for s in range(len(b) - length + 1):
            first[b[s : s + length]] = min(first.get(b[s : s + length], i), i)
    out = {}
    for i, b in docs:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < i:
                gone[s : s + length] = True
        out[i] = (int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes() if b else b"").hexdigest())
    return out


@pytest.mark.parametrize(("hot", "batch"), [(8192, 700), (2, 900)])
def test_repeats_against_brute_force(spark, hot, batch):
    rng = random.Random(9)
    base = "".join(rng.choice("abé ") for _ in range(500))
    rows = []
    for i in range(160):
        at = rng.randrange(450)
        t = "".join(rng.choice("xyz") for _ in range(rng.randrange(50))) + base[at : at + rng.randrange(130)] + "".join(rng.choice("xyz") for _ in range(rng.randrange(50)))
        rows.append((rng.randrange(10**6) * 1000 + i, rng.choice((t, t, t + t, "ab" * 70, rows[0][1] if rows else t))))
    want = brute_repeats([(i, t.encode()) for i, t in rows])
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), batch_bytes=batch, hot_documents=hot, merge_entries=40).collect()
    assert {r["doc_id"]: (sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got} == want


def test_repeats_on_awkward_rows(awkward, empty):
    got = suffix_dedup.remove_repeats(awkward).collect()
    assert len(got) == len(AWKWARD)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_bytes"] == 0 and by[7]["n_bytes"] == len(LONG) + 5 and bytes(by[7]["kept"]).endswith(b"tail") and by[6]["spans"] == []
    assert suffix_dedup.remove_repeats(empty).count() == 0
    out = suffix_dedup.without_repeats(awkward.where("doc_id in (6, 7, 9)"))
    assert out.columns == awkward.columns and out.where("doc_id = 6").first()["text"] == LONG


def test_without_repeats_keeps_awkward_rows(spark, awkward, empty):
    def shown(df):
        return sorted(((r["doc_id"], r["text"], r["at"]) for r in df.select("doc_id", "text", "at").collect()), key=str)

    want = [(i, " tail" if i == 7 else t, 7) for i, t, *_ in AWKWARD]
    got = suffix_dedup.without_repeats(awkward)
    assert got.columns == awkward.columns and shown(got) == sorted(want, key=str)
    assert suffix_dedup.without_repeats(empty).count() == 0
    passage = "".join(chr(0x4E00 + i) for i in range(40))
    rows = [(1, "x" + passage), (2, "a\ufffdb" + passage + "é\ufffd"), (2, "a\ufffdb" + passage + "é\ufffd"), (2, "other"), (3, passage), (None, passage + "end"), (None, "x" + passage), (None, None), (4, "head" + passage.encode()[1:-1].decode("utf-8", "ignore") + "\u4eff")]
    got = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    tail = "a\ufffdbé\ufffd"
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "x" + passage), (2, tail), (2, tail), (2, "other"), (None, "end"), (None, None), (4, "head")], key=str)


def test_cut_drops_only_split_characters(spark):
    text = "aé\ufffd世\U0001f600z"  # bytes: a 0, é 1-2, U+FFFD 3-5, 世 6-8, emoji 9-12, z 13
    raw = text.encode()
    cases = [(a, z) for a in range(len(raw)) for z in range(a + 1, len(raw) + 1)]
    df = spark.createDataFrame([(text, [(a, z)]) for a, z in cases], "text string, spans array<struct<start:long,end:long>>")
    got = [r[0] for r in df.coalesce(1).select(suffix_dedup._cut(F.col("text"), F.col("spans"))).collect()]
    assert got == [raw[:a].decode("utf-8", "ignore") + raw[z:].decode("utf-8", "ignore") for a, z in cases]


def test_loser_tree_keeps_prefixes():
    rng = random.Random(2)
    same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))
    for _ in range(100):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(7)) for _ in range(rng.randrange(9))) for _ in range(rng.randint(1, 6))]
        lcps = [[0, *map(same, r, r[1:])][: len(r)] for r in runs]
        run, index, lcp = suffix_dedup.merge_runs(runs, lcps)
        merged = [runs[a][b] for a, b in zip(run, index, strict=True)]
        assert merged == sorted(x for r in runs for x in r)
        assert lcp == [0, *map(same, merged, merged[1:])][: len(merged)]


@pytest.mark.parametrize(("page_rows", "regions"), [(8, 3), (64, 1024)])
def test_top_k_against_brute_force(spark, page_rows, regions):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 12)).astype(float)
    v[100:160] = v[100]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(5000, None), (5050, [1.0, None]), (5100, [float("nan")] * 12), (5150, [float("inf")] * 12), (5200, []), (50, [float(x) for x in v[50]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = collections.defaultdict(list)
    for r in metric_tree.search(df, lambda i: i % 50 == 0, tree_rows=40, block_rows=6, page_rows=page_rows, max_regions=regions).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    z = np.floor(256 * v).astype(np.int64)
    z, ids = np.vstack((z, np.zeros(12, np.int64))), [*range(700), 5200]
    for q in [*range(0, 700, 50), 5200]:
        s = z @ z[ids.index(q)]
        best = sorted(((-int(x), i) for x, i in zip(s, ids, strict=True) if i != q))[:5]
        assert got[q] == [(n, i, -x) for n, (x, i) in enumerate(best, 1)]
    assert metric_tree.search(df.where("vec_id < 3"), lambda i: i == 1).count() == 2
    assert metric_tree.search(df.limit(0), lambda i: i == 1).count() == 0


@pytest.mark.parametrize("depth", [3, 4])
def test_context_tree_equals_sequential_weighting(depth):
    import copy
    import math

    train = [b"abracadabra abracad", b"the cat sat on the mat", b"the cab sat", b""]
    nodes, kids = {}, collections.defaultdict(float)

    def update(ctx, node, bit):
        top = nodes.get((node, ()), [0, 0, 0.0, 0.0])[3]
        change = 0.0
        for key in ((node, ctx[:d]) for d in range(depth, -1, -1)):
            x = nodes.setdefault(key, [0, 0, 0.0, 0.0])
            x[2] += math.log((x[bit] + 0.5) / (x[0] + x[1] + 1))
            x[bit] += 1
            if len(key[1]) < depth:
                kids[key] += change
            new = x[2] if len(key[1]) == depth else math.log(0.5) + np.logaddexp(x[2], kids[key])
            change, x[3] = new - x[3], new
        return nodes[node, ()][3] - top

    def feed(data, ctx=None):
        ctx, total = ctx or (0,) * depth, 0.0
        for byte in data:
            node = 1
            for k in range(7, -1, -1):
                total += update(ctx, node, byte >> k & 1)
                node = 2 * node + (byte >> k & 1)
            ctx = (byte, *ctx[:-1])
        return total

    for t in train:
        feed(t + b"\0")
    data = b"".join(t + b"\0" for t in train)
    codes, n = np.unique(context_tree.strings(data, np.cumsum([len(t) + 1 for t in train]), depth), return_counts=True)
    asked = [(ctx, byte) for ctx in (b"", b"the ", b"ca", b"zz", b"zthe") for byte in b"atbz\0 "]
    wanted = [context_tree.strings(ctx + bytes([byte]), np.array([len(ctx) + 1]), depth)[-1] for ctx, byte in asked]
    every = np.union1d(codes, wanted)
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, codes)] = n
    deep = context_tree.Deep(every, counts, depth)
    three, inverse = np.unique(context_tree.triples(codes, depth), return_inverse=True)
    top = context_tree.Top.build(three, np.bincount(inverse, weights=n), deep.keys, deep.below)
    found = deep.log10(every, top)
    for (ctx, byte), code in zip(asked, wanted, strict=True):
        held = copy.deepcopy((nodes, dict(kids)))
        p = feed(bytes([byte]), (*ctx[::-1], *[0] * depth)[:depth]) / math.log(10)
        nodes.clear()
        nodes.update(held[0])
        kids.clear()
        kids.update(held[1])
        assert abs(p - found[np.searchsorted(every, code)]) < 1e-5, (ctx, byte)


def test_scores_and_base_model(spark, awkward, empty):
    got = context_tree.score(awkward, docs_per_range=3, batch_bytes=500).collect()
    assert len(got) == len(AWKWARD)
    tokens_of = [(i, [*(t or "").encode().lower().split(), None]) for i, t, *_ in AWKWARD]
    train = collections.Counter(w for i, ws in tokens_of if not context_tree.held_out(i, 10) for w in ws)
    n, v = sum(train.values()), len(train)
    want = sorted((str(i), len(ws), sum(train[w] > 0 for w in ws), round(sum(np.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in tokens_of)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert context_tree.held_out(12, 10) == (zlib.crc32(b"12") % 10 == 0)
    assert context_tree.score(empty).count() == 0
    assert all(np.isfinite(r["score"]) for r in context_tree.score(spark.createDataFrame([(None, "only held out")], "doc_id long, text string")).collect())


def test_toxicity_learns_and_generalises(spark, awkward, empty):
    rng = random.Random(6)
    plain = ["".join(rng.choice(("ra", "ti", "no", "the", "or", "in")) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    bad = ["idiot", "moron", "scumbag", "worthless", "pathetic"]
    rows = []
    for i in range(500):
        toxic = i % 5 == 0
        t = [rng.choice(plain) for _ in range(rng.randint(5, 200))]
        for _ in range(3 * toxic):
            t[rng.randrange(len(t))] = rng.choice(bad)
        rows.append((i, " ".join(t), int(toxic)))
    docs, labels = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"), buckets=1 << 14)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(got[i] >= 0.5) == bool(x) for i, _, x in rows if i % 3 == 0]
    assert np.mean(held) > 0.95
    assert model.word_margin(b"idiott") > 0 > model.word_margin(b"ratino")
    odd = toxicity.score(awkward, model).collect()
    assert len(odd) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(docs, labels.limit(0)).bias == 0.0
    assert toxicity.fit(docs, labels.where("toxic = 0")).bias < 0


def test_long_texts_keep_their_toxic_window():
    at, end, value = toxicity.best_window(np.array([0.0] * 1000 + [9.0, 9.0] + [0.0] * 500), 4)
    assert at <= 1000 and end >= 1002 and value == pytest.approx(4.5)
    assert toxicity.best_window(np.empty(0), 4) == (0, 0, 0.0)


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var x="</p>";</script></head><body class="menu-open">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use cookies, really.</div>
<article><h1>Head&nbsp;line</h1><p>First <b>bold</b>,\n  text &lt;ok&gt;.<p>Second, longer, text; here.<br>More.</p><aside>Aside text, long enough.</aside><form><input>Name</form>
<div class='ad-slot'>Buy now, please.</div></article><section id="comments"><p>I disagree, a lot, with all of this.</p></section><footer>&copy; x</footer>"""


def test_html_main_text(spark):
    assert " ".join(html_text.main_blocks(PAGE)) == "Head line First bold, text <ok>. Second, longer, text; here. More."
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "no tags &amp; none"), (5, "u", "<p>a <!-- open"), (5, "u", "<script>if(a<b)</script"), (6, "u", "<div><p>x</div>" * 3000), (7, "u", "<" * 500 + "a b='>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "n_blocks": F.lit(-1)})
    found = html_text.extract(df).collect()
    assert all((r["text"], r["n_blocks"]) == ("clash", -1) for r in found)
    got = {(r["page_id"], r["n_blocks_"]): r["text_"] for r in found}
    assert got[2, 0] == "" and got[3, 0] == "" and got[4, 1] == "no tags & none" and got[5, 1] == "a" and got[5, 0] == "" and got[6, 3000].count("x") == 3000
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_without_article_takes_the_text_paths():
    text = "A sentence, with commas, that is long enough to be the text of a page. And another one."
    page = f"<body><div class=top><a href=x>One</a> <a href=y>Two</a></div><div id=c><p>{text}</p><p>{text}</p></div><div class=low><span>x</span></div></body>"
    assert html_text.main_blocks(page) == [text, text]


def test_html_without_article_keeps_lists_tables_quotes_and_headings():
    text = "A sentence, with commas, that is long enough to be the text of a page; it says much. " * 4
    item, link = "A short item of a list without much to say.", "<li><a href=x>Elsewhere on this site</a></li>"
    inner = f"<h2>A heading</h2><p>{text}</p><ul>" + f"<li>{item}</li>" * 6 + f"</ul><p>{text}</p><table><tr><th>Name</th><td>Value</td></tr></table><blockquote><p>Quoted words</p></blockquote><div><dl><dt>Term</dt><dd>Meaning</dd></dl></div>"
    want = ["A heading", text.strip(), *[item] * 6, text.strip(), "Name", "Value", "Quoted words", "Term", "Meaning"]
    around = f"<div class=top><ul>{link * 5}</ul></div>", "<div class=low><span>Made by us</span></div>"
    assert html_text.main_blocks(f"<body>{around[0]}<div class=content>{inner}</div>{around[1]}</body>") == want
    assert html_text.main_blocks(f"<body>{around[0]}<div class=page><div class=content>{inner}<ul class=more>{link * 5}</ul></div></div>{around[1]}</body>") == want
    assert html_text.main_blocks(f"<body>{around[0]}<div class=content>{text}<br>{text}<ul><li>{item}</li></ul></div></body>") == [text.strip(), text.strip(), item]


def test_html_smoothing_equals_all_pairs_of_paths():
    rng = random.Random(12)
    parts = []
    for _ in range(150):
        parts.append(rng.choice(("<div class=a>", "<div class=b>", "<ul><li>", "</div>", "</ul>", "<p>", "<section>", "</section>")))
        parts.append(rng.choice(("words, and marks. ", "", "short", "longer words that say more; ")))
    page = html_text.parse("".join(parts))
    paths = []
    for p in range(len(page.parent)):
        at = []
        while p >= 0:
            at.append(p)
            p = page.parent[p]
        paths.append(at[::-1])
    ratio, decay = html_text.ratios(page), 0.3
    for p, got in enumerate(html_text.smoothed(page, ratio, decay)):
        top = below = 0.0
        for q, n in enumerate(page.count):
            if n:
                w = sum(decay ** (len(paths[p]) - j) for j in range(1, 1 + sum(x == y for x, y in zip(paths[p], paths[q], strict=False))))
                top, below = top + w * ratio[q], below + w
        assert got == pytest.approx(top / below)
    assert sum(1 for c in page.count if c) > 20


def test_html_ratios_alone_find_the_text():
    text = "A sentence, with commas, that is long enough to be the text of a page. And another one, of the same kind."
    body = f"<h1>Head line</h1><p>{text}</p><p>{text}</p><ul><li>An item</li><li>More of it</li></ul><p>{text}</p>"
    around = "<div class=x><ul>" + "<li><a href=y>Elsewhere</a></li>" * 6 + "</ul></div><div class=y>We bake cookies here.</div>", "<div class=z>All rights reserved. Made by us.</div>"
    want = ["Head line", text, text, "An item", "More of it", text]
    assert html_text.main_blocks(f"<body>{around[0]}<div class=w>{body}</div>{around[1]}</body>", hints=False, prior=1.0) == want
    inside = f"<body><main>{body}<div class=more>{'<a href=q>Read this too</a> ' * 9}</div></main></body>"
    assert html_text.main_blocks(inside) == want
    flat = html_text.parse(inside)
    scores = html_text.path_scores(flat, ratio=[float(c > 0) for c in flat.count])
    assert [t for t, p in flat.blocks if scores[p] >= 0.6 * max(scores)] != want


def test_html_time_is_linear_in_paths():
    import time

    hostile = ("".join(f"<x{i}><p>some text, here." for i in range(20_000)), "".join(f"<div class=c{i}><p>some text, here.</p></div>" for i in range(20_000)), '<a "' * 100_000, "</b>" * 100_000 + "<i>" * 50_000)
    for page in hostile:
        began = time.process_time()
        html_text.main_blocks(page)
        assert time.process_time() - began < 5


def test_html_class_names():
    body = "<p>The text of the page, which is what matters.</p>"
    assert html_text.main_blocks(f"<div class='content with-sidebar'>{body}</div><div class='left-sidebar'>{body}</div>") == ["The text of the page, which is what matters."]
    assert html_text.main_blocks(f"<main>{body}<article class='comment first'><p>Not me, I disagree.</p></article></main>") == ["The text of the page, which is what matters."]


def test_url_rules_and_trees(spark):
    rules = [("https://a.com/en/1", "block", "com/en/"), ("http://Example.COM/en/7x?q", "allow", "example.com/en/7"), ("http://x.net/de/1", "allow", "net/de/"), ("http://example.net/de/80#f", "block", "example.net/de/8"), ("http://m.example.net/de/9", "allow", "net/de/"), ("http://o.org/es/", "block", "org/es/"), ("http://notcom/en/1", None, None), ("no scheme", None, None), (None, None, None), ("http://h?x=/en/", None, None), ("://com/en/", "block", "com/en/")]
    df = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(rules)], "page_id int, url string").withColumns({"host": F.lit("clash"), "depth": F.lit(3.5), "verdict": F.lit("mine"), "rule_verdict": F.lit("block"), "times": F.lit(1)})
    found = urls.judge(df).collect()
    assert all((r["host"], r["depth"], r["verdict"], r["rule_verdict"], r["times"]) == ("clash", 3.5, "mine", "block", 1) for r in found)
    got = {r["page_id"]: {"rule": r["rule"], "verdict": r["verdict_"], "host": r["host_"], "path": r["path"]} for r in found}
    for i, (_, verdict, rule) in enumerate(rules):
        assert got[i]["rule"] == rule and got[i]["verdict"] in ("allow", "block") and (verdict is None or got[i]["verdict"] == verdict)
    assert (got[1]["host"], got[1]["path"]) == ("example.com", "/en/7x") and (got[7]["host"], got[8]["path"], got[9]["path"]) == ("", "", "")
    assert urls.judge(df.limit(0)).count() == 0
    many = spark.range(1200).select(F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("http://a.com/en/"), "id")).otherwise(F.concat(F.lit("http://b.net/de/"), "id")).alias("url"))
    fresh = spark.createDataFrame([(9001, "http://zz.com/fr/4"), (9002, "http://zz.net/fr/4")], "page_id long, url string")
    out = {r["page_id"]: r["verdict"] for r in urls.judge(many.unionByName(fresh)).where("page_id > 9000").collect()}
    assert out == {9001: "block", 9002: "allow"}


def test_url_sample_is_of_different_urls(spark):
    df = spark.createDataFrame([("http://hot.com/en/1", "block")] * 900 + [(f"http://a{i}.net/de/{i}", "allow") for i in range(300)], "url string, rule_verdict string")
    rows = urls.sample(df, 301, 100).collect()
    assert len(rows) == 100 == len({r["url"] for r in rows}) and all(r["times"] == (900 if "hot" in r["url"] else 1) for r in rows)
    many = spark.range(40_000).select(F.concat(F.lit("http://x.net/de/"), "id").alias("url"), F.lit("allow").alias("rule_verdict"))
    some = urls.sample(many, 40_000, 1000)
    assert some.count() == 1000


def test_toxicity_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (1 + i % 7)) for i in range(3000)] + [(5, "a second text"), (6, None), (7, "long " * 40_000), (None, "x")], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = toxicity.sample(docs, labels, 400, 1 << 20, "doc_id", "text", "toxic").collect()
    assert len(got) == 400 and all(len(r["text"]) <= 1 << 14 for r in got)
    few = toxicity.sample(docs, labels, 5000, 2000, "doc_id", "text", "toxic").collect()
    assert 0 < sum(len(r["text"]) for r in few) <= 2000
    everything = toxicity.sample(docs, labels, 5000, 1 << 30, "doc_id", "text", "toxic").collect()
    assert len(everything) == 3000


def test_subwords_do_not_depend_on_neighbours():
    words = [b"hello", b"", b"!!", b"a", "ünïcode".encode(), b"(word)", b"x" * 300, b"\xff\xfe"]
    owner, bucket = toxicity.subwords(words, 1 << 16)
    for i, w in enumerate(words):
        alone = toxicity.subwords([w], 1 << 16)[1]
        assert (bucket[owner == i] == alone).all() and len(alone) == max(1, sum(max(0, len(w.strip(toxicity.TRIM).decode("utf-8", "replace")) + 3 - k) for k in range(3, 7)))
    assert (np.diff(owner) >= 0).all()


@pytest.mark.parametrize("broadcast", [100_000, 10])
def test_url_trees_know_the_suffixes_of_all_hosts(spark, monkeypatch, broadcast):
    monkeypatch.setattr(urls, "BROADCAST_SUFFIXES", broadcast)
    what = ["block" if random.Random(i).random() < 0.5 else "allow" for i in range(150)]
    rules = [(w, f"h{i:03}.zz", "/") for i, w in enumerate(what)]
    df = spark.createDataFrame([(i, f"http://h{i:03}.zz/{j}") for i in range(150) for j in range(8)] + [(1000 + i, f"http://h{i:03}.zz?x") for i in range(150)], "page_id long, url string")
    counts = urls.suffix_counts(urls.with_features(urls.apply_rules(urls.parse(df), rules))).collect()
    want = {("suffix1", "zz"): (8 * what.count("block"), 1200)} | {(k, f"h{i:03}.zz"): (8 * (w == "block"), 8) for i, w in enumerate(what) for k in ("suffix2", "suffix3")}
    assert {(r["level"], r["suffix"]): (r["blocked"], r["n"]) for r in counts} == want
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(df, rules).where("page_id >= 1000").collect()}
    assert got == {1000 + i: (None, w) for i, w in enumerate(what)}


def test_scores_of_texts_equal_sequential_weighting(spark):
    """Whole texts, through several ranges, batches and tasks, against a model that learns byte by byte."""
    import math

    depth, rng = 3, random.Random(21)
    texts = ["".join(rng.choice(("ab", "ra", "cad", " ", "é")) for _ in range(rng.randrange(9))) for _ in range(24)] + [None, "", "abracad", "abracad"]
    rows = [(i * 7 + 1, t) for i, t in enumerate(texts)]
    nodes = collections.defaultdict(lambda: [0, 0])

    def decisions(text):
        context = (0,) * depth
        for byte in (text or "").encode() + b"\0":
            node = 1
            for k in range(7, -1, -1):
                bit = byte >> k & 1
                yield node, context, bit
                node = 2 * node + bit
            context = (byte, *context[:-1])

    for i, t in rows:
        if not context_tree.held_out(i, 10):
            for node, context, bit in decisions(t):
                for d in range(depth + 1):
                    nodes[node, context[:d]][bit] += 1
    children = collections.defaultdict(list)
    for node, context in list(nodes):
        if context:
            children[node, context[:-1]].append(context)
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node, context):
        own = kt(*nodes.get((node, context), (0, 0)))
        if len(context) == depth:
            return own
        return math.log(0.5) + np.logaddexp(own, sum(weighted(node, c) for c in children[node, context]))

    def chance(node, context, bit):
        """Conditional probability of one more decision: the weighted probability with it over that without."""
        before = weighted(node, ())
        path = [(node, context[:d]) for d in range(depth + 1)]
        new = [k for k in path if k not in nodes]
        for k in path:
            nodes[k][bit] += 1
            if k in new and k[1]:
                children[k[0], k[1][:-1]].append(k[1])
        after = weighted(node, ())
        for k in path:
            nodes[k][bit] -= 1
            if k in new:
                del nodes[k]
                if k[1]:
                    children[k[0], k[1][:-1]].remove(k[1])
        return after - before

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in context_tree.score(df, docs_per_range=2, batch_bytes=30, depth=depth).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(sum(chance(*x) for x in decisions(t)) / math.log(10), abs=1e-3), (i, t)
