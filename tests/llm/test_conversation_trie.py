import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quern.llm import conversation_trie
from quern.llm.conversation_trie import Params

SCHEMA = "conv_id long, turn long, role string, text string"
#: Everything is cut, dealt and chained with these.
SMALL = Params(most_turns=4, bucket_turns=10, salts=3)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in children[p])
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(made[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, params=Params()):
    return sorted((tuple(r) for r in conversation_trie.rebuilt_trie(df, params).collect()), key=str)


def talks(seed, n=260, deep=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 700), n):
        for t in range(rng.randint(1, deep)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bé", "same words"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("params", [Params(), SMALL])
def test_random_talks(spark, params):
    rows = talks(1)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5), params) == brute(rows)


def test_a_hot_first_turn_and_many_copies(spark):
    rows = [(c, t, "user", "hello" if t == 0 else f"{'' if c % 3 else c} {t}") for c in range(0, 30_000, 100) for t in range(3)]
    for params in (Params(most_turns=50, bucket_turns=40), Params()):
        assert found(spark.createDataFrame(rows, SCHEMA), params) == brute(rows)


def test_one_very_long_talk_and_a_very_long_text(spark):
    rows = [(100, t, "user", str(t)) for t in range(300)] + [(101, 0, "user", "x" * 200_000), (102, 5, "user", "0"), (200, 0, "user", "0")]
    for params in (SMALL, Params()):
        assert found(spark.createDataFrame(rows, SCHEMA), params) == brute(rows)


def test_nulls_ties_repeats_and_missing_heads(spark):
    rows = [(None, 0, "user", "a"), (7, None, None, None), (7, 1, "user", None), (7, 1, "user", None), (7, None, "", ""), (305, 0, "user", "a"), (401, 0, "a", "b"), (401, 1, "", "ab"), (402, 0, "", "ab"), (402, 1, "ab", "")]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert sum(r[1] == 0 for r in got) == 1


def test_roles_and_texts_are_not_run_together(spark):
    turns = spark.createDataFrame([(1, 0, "a", "bc"), (2, 0, "ab", "c")], SCHEMA)
    placed = conversation_trie.numbered(conversation_trie.turns_of(turns), 2)
    assert conversation_trie.trie(placed.select("conv_id").distinct(), placed).where("depth = 1").count() == 2


def test_extra_columns_and_no_rows(spark):
    rows = talks(2, 40)
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("x").alias(c) for c in ("key", "rep", "at", "place", "part_place", "digest", "salt", "n_chars")))
    assert found(clash) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_whole_smallest_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    for params in (SMALL, Params()):
        assert found(table, params) == want
