"""Pipeline stages against brute force, on rows with null and repeated ids and columns whose names clash."""

import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import AWKWARD, SCHEMA, brute_repeats, counts, jaccard_classes, words
from wayfare.llm import minhash, mixing, quality, suffix_dedup

CLASH = ("quality", "kept", "size", "target", "slot", "place", "node", "group", "least", "gone", "spans", "digest", "rep", "epoch", "at", "src_key", "rank")


@pytest.fixture(scope="module")
def clashing(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).withColumns({c: F.lit(f"my {c}") for c in CLASH})


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_columns_of_any_name_come_back_untouched(spark, clashing, stage):
    out = stage[1](spark, clashing, "")
    assert out.columns == clashing.columns
    assert all(r[c] == f"my {c}" for r in out.collect() for c in CLASH)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_empty_tables_give_empty_tables(spark, stage):
    assert stage[1](spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, left = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return {**fixed, **{s: left * weight[s] / total for s in free}}
        for s in over:
            fixed[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(fixed.values())


def brute_mix(rows, block):
    """Places of rows in the order of the mix."""
    by = collections.defaultdict(list)
    for i, (doc, text, source) in enumerate(rows):
        by[source].append((hashlib.md5(str("" if doc is None else doc).encode()).hexdigest(), doc is not None, doc or 0, len(words(text)), i))
    sizes = {s: sum(x[3] for x in v) for s, v in by.items()}
    limit = {s: math.floor(t) for s, t in targets(sizes).items()}
    key = {s: "null" if s is None else "=" + s for s in by}
    need = {s: -(-limit[s] // block) for s in by if limit[s]}
    order = sorted(need, key=lambda s: key[s])
    slots, total, ranks = {}, sum(need.values()), collections.Counter()
    for n in range(total):
        x, low = n * 0.6180339887498949 % 1.0, 0
        for s in order:
            if low / total <= x < (low + need[s]) / total:
                if ranks[s] < need[s]:
                    slots[s, ranks[s]] = n
                ranks[s] += 1
            low += need[s]
    for s in order:
        for k in range(ranks[s], need[s]):
            slots[s, k] = total + k
    out = []
    for s in order:
        for epoch in (0, 1):
            start = epoch * sizes[s]
            for *_, size, i in sorted(by[s]):
                blocks = [(slots[s, b], max(start, b * block) - b * block) for b in range(start // block, -(-min(start + size, limit[s]) // block))] if size and start < limit[s] else []
                out += [(min(blocks), i)] if blocks else []
                start += size
    return [i for _, i in sorted(out)]


def test_mix_against_brute_force(spark):
    rows = [(i if i % 11 else None, "w " * (1 + i * 7 % 23) if i % 13 else None, ("a", "b", "a", None, "é")[i % 5]) for i in range(400)]
    rows += [(9000 + i, "x y z " * 9, "a") for i in range(200)]
    rows += [(7, "again " * 40, "b"), (7, "again " * 41, "b"), (7, "other " * 3, "é")]
    seen, rows = set(), [r for r in rows if r[0] is not None or len(words(r[1])) not in [0]]
    rows = [r for r in rows if (r[0], len(words(r[1])), r[2]) not in seen and not seen.add((r[0], len(words(r[1])), r[2]))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, doc_id long, text string, source string").repartition(3)
    want = brute_mix(rows, 16)
    got = [r["n"] for r in mixing.mixed_documents(df, block_words=16).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert got == want
    # every prefix of what is written is near the weights
    taken = {s: sum(len(words(rows[i][1])) for i in want if rows[i][2] == s) for s in {r[2] for r in rows}}
    whole, run = sum(taken.values()), collections.Counter()
    for i in got:
        run[rows[i][2]] += len(words(rows[i][1]))
        assert all(abs(run[s] - taken[s] / whole * sum(run.values())) < 16 * 12 for s in taken)


def test_stages_against_brute_force(spark, tmp_path):
    base = " ".join(f"the word{i} of w{i % 37}" for i in range(60))
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [(i, f"{base} own{i} " * 2 + f" of the{i}") for i in range(3)]
    rows += [(10 + i, " ".join(f"and d{i}x{j} to" for j in range(80)) + " " + passage) for i in range(5)]
    rows += [(10, " ".join(f"is z{j} for" for j in range(70))), (None, " ".join(f"was n{j} with" for j in range(70))), (None, rows[4][1]), (4, "too short"), (5, None), (20, "\n".join(["the same line of it"] * 30))]
    df = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], SCHEMA)
    df.write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    shown = lambda d: sorted(((r["doc_id"], r["text"]) for r in d.collect()), key=str)
    good = quality.keep_good(df)
    kept = shown(good)
    for doc, text in rows:
        n, _, _, _, repeated = counts(text)
        if n < 50 or 100 * repeated > 50 * n:
            assert (doc, text) not in kept
    assert len(kept) >= 7 and set(kept) <= set(rows)
    one = minhash.keep_one(good)
    ids = {i: (doc if doc is not None else 10**9 + i, text) for i, (doc, text) in enumerate(kept)}
    classes, _ = jaccard_classes([(i, t) for i, (_, t) in ids.items()], 5, 80)
    first = {}
    for i, c in classes.items():
        if c not in first or ids[i][0] < ids[first[c]][0]:
            first[c] = i
    assert shown(one) == sorted((kept[i] for i in first.values()), key=str)
    left = shown(one)
    number = {i: (doc if doc is not None else 2**63 - 1) for i, (doc, _) in enumerate(left)}
    want = []
    for i, (doc, text) in enumerate(left):
        others = [(number[j], t.encode()) for j, (_, t) in enumerate(left) if j != i and number[j] < number[i]]
        gone = brute_repeats([*dict.fromkeys([(0, b"\n".join(t for _, t in others))]), (1, text.encode())])[1]
        want.append((doc, len(text.encode()) - gone[0]))
    got = sorted(((r["doc_id"], len(r["text"].encode())) for r in suffix_dedup.without_repeats(one).collect()), key=str)
    assert got == sorted(((d, n) for d, n in want if n), key=str)
