import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import near_duplicates as near

SCHEMA = "doc_id long, text string"


def shingles(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def brute(rows, words, percent=80):
    """(id, size, component) of every row, by all pairs."""
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((d, len(s), d if not s else least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df, params):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near.find(df, params).collect()), key=str)


def family(rng, n, length=60, edits=6):
    base = [f"w{rng.randrange(2000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(length)] = f"e{rng.randrange(2000)}"
        out.append(" ".join(words))
    return out


def test_more_wanted_texts_than_marks_can_tell(spark, monkeypatch):
    monkeypatch.setattr(near, "MOST_BITS", 1 << 10)
    rng = random.Random(9)
    texts = [t for _ in range(20) for t in family(rng, 4)] + ["a b c d e f"] * 40 + [" ".join(f"w{rng.randrange(2000)}" for _ in range(40)) for _ in range(60)]
    rows = list(enumerate(texts))
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(7), near.Params(words=2)) == brute(rows, 2)


@pytest.mark.parametrize("words", [2, 5])
def test_families_match_brute_force(spark, words):
    rng = random.Random(words)
    texts = [t for _ in range(12) for t in family(rng, rng.randint(1, 25))] + ["a b c"] * 30 + [" ".join(f"w{rng.randrange(2000)}" for _ in range(40)) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(6), near.Params(words=words)) == brute(rows, words)


def test_tiles_of_large_families_lose_no_link(spark):
    rng = random.Random(9)
    rows = list(enumerate(family(rng, 150, 80, 9)))
    small = near.Params(words=2, tile_nodes=20, tile_shingles=1000)
    assert got(spark.createDataFrame(rows, SCHEMA), small) == brute(rows, 2)


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "One two"), (7, "one  two\n"), (None, "one two"), (None, "alone here"), (8, "é two"), (8, "É two"), (9, "x y z"), (9, "x y z"), (9, "other words"), (-3, "\x1cone two")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df.withColumn("node", F.lit(1)).withColumn("kept", F.lit(2)), near.Params(words=2)) == brute(rows, 2)
    kept = {(r.doc_id, r.n_shingles): r.kept for r in near.find(df, near.Params(words=2)).collect()}
    assert kept[1, 0] and kept[6, 1] and not kept[7, 1]
    assert near.find(df.limit(0)).count() == 0


def test_keep_one(spark):
    rows = [(5, "a b c d e f", "x"), (3, "a b c d e f", "y"), (3, "a b c d e f", "y"), (8, "", "z"), (9, None, "z"), (None, "a b c d e f", "n"), (None, "only without an id here", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, drop_id string")
    out = near.keep_one(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[1], rows[3], rows[4], rows[6]], key=str)


def test_shingles_are_distinct_and_case_folds_ascii_only():
    of = near.Shingler(near.Params(words=2))
    assert len(of.shingles("a b a b a")) == 2
    assert (of.shingles("A b") == of.shingles("a B")).all() and (of.shingles("É b") != of.shingles("é b")).all()
    assert len(of.shingles("a\x85b c")) == 1 and len(of.shingles("word " * 100_000)) == 1


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    of = near.Shingler(near.Params(k=400))
    a, b = rng.integers(0, 2**63, 3000, dtype=np.uint64), rng.integers(0, 2**63, 1000, dtype=np.uint64)
    x, y = of.signatures([a, np.concatenate([a[1000:], b])])
    assert (x == y).mean() == pytest.approx(0.5, abs=0.08)


def test_pairs_at_the_least_similarity_are_hardly_missed():
    p = near.Params()
    missed = sum(math.comb(p.k, i) * 0.8**i * 0.2 ** (p.k - i) for i in range(p.matches))
    assert missed < 1e-6 and p.prefix == p.k - p.matches + 1


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(i, i + 7) for i in range(60)]])
def test_components(spark, edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame([(b, a) if (a + b) % 3 else (a, b) for a, b in edges], "a long, b long")
    assert {r.node: r.component for r in near.components(df).collect()} == {x: root(x) for x in parent}


def test_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs, near.Params(words=2)) == brute(rows, 2)


def chain(rng, n, length=120, edits=8):
    """Each text is near the one before, and far from those long before."""
    words = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        for _ in range(edits):
            words[rng.randrange(length)] = f"w{rng.randrange(5000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("tile", [4, 16])
def test_groups_of_several_components_lose_no_link(spark, monkeypatch, tile):
    rounds, second = [], near.second_tiles
    monkeypatch.setattr(near, "second_tiles", lambda *a: rounds.append(second(*a)) or rounds[-1])
    rng = random.Random(tile)
    rows = list(enumerate([*chain(rng, 120), *chain(rng, 60, 60, 3), *family(rng, 60)]))
    params = near.Params(words=2, tile_nodes=tile)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4), params) == brute(rows, 2)
    assert rounds[0] is not None


@pytest.mark.parametrize("n", [200, 800])
def test_rows_of_a_family_grow_with_its_size(spark, n):
    rng = random.Random(3)
    docs = spark.createDataFrame(list(enumerate(family(rng, n, 120, 4))), SCHEMA)
    params = near.Params(words=2, tile_nodes=20)
    nodes = near.nodes_of(near.prints(docs, params, "doc_id", "text"))
    placed = near.stored(near.placed_of(near.groups(nodes, params), nodes, params), "placed")
    members, rows = placed.count(), near.first_tiles(placed)
    assert placed.agg(F.max("blocks")).first()[0] >= n // 40
    assert rows.count() <= members * (1 + 2 * near.PIVOTS / 20) + 200
    linked = near.components(near.links(near.stored(near.candidates(rows.join(nodes.select("node", "signature"), "node"), params), "found"), nodes, near.full_sets(docs, nodes, params, "text"), params))
    assert near.second_tiles(placed, linked, params) is None  # pivots have joined the family


def broadcast_joins(spark, run):
    """How many joins with a broadcast side each execution of run() ended with."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark._jsc.sc().listenerBus()
    bus.waitUntilEmpty(60_000)
    known = store.executionsList()
    last = max([-1, *(known.apply(i).executionId() for i in range(known.size()))])
    run()
    bus.waitUntilEmpty(60_000)
    found, out = store.executionsList(), []
    for x in (found.apply(i).executionId() for i in range(found.size())):
        if x > last:
            nodes = store.planGraph(x).allNodes()
            out.append(sum(nodes.apply(i).name().startswith("Broadcast") and "Join" in nodes.apply(i).name() for i in range(nodes.size())))
    return out


def test_no_side_of_a_join_goes_through_the_driver(spark):
    rng = random.Random(5)
    texts = [*chain(rng, 40), *family(rng, 40), *family(rng, 3), "a b c", "a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    params = near.Params(words=2, tile_nodes=8)
    joins = broadcast_joins(spark, lambda: near.find(docs, params).collect())
    assert len(joins) > 5 and not any(joins)
    joins = broadcast_joins(spark, lambda: near.keep_one(docs, params).collect())
    assert sum(joins) == 2  # the bounded marks, twice
