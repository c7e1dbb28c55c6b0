import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quern.llm import queries, token_output

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(20))
def test_segment_tree_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    got = token_output.best_fit_decreasing(lengths, capacity)
    assert sorted(capacity - sum(lengths[i] for i in s) for s in got) == sorted(rooms)
    assert sorted(i for s in got for i in s) == list(range(len(lengths)))


@pytest.mark.parametrize(("capacity", "window"), [(64, 10), (2048, 4096)])
def test_round_trip(spark, sf_dir, capacity, window):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "word " * 5000)], docs.schema))
    rows = token_output.pack(docs, PATH, capacity, window=window).collect()
    pieces, whole = token_output.unpacked(rows, capacity), defaultdict(bytes)
    for (doc_id, _), ids in sorted(pieces.items()):
        whole[doc_id] += ids
    library = Tokenizer.from_file(PATH)
    assert dict(whole) == {r.doc_id: np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for r in docs.collect()}
    assert token_output.pack(docs.limit(0), PATH).count() == 0


def test_the_query_equals_a_plain_pack(spark, sf_dir):
    """Sequence by sequence: ids, cumulative lengths, positions and members of every task's windows."""
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()  # one file: one task
    pieces = []
    for r in docs:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        pieces += [(r.doc_id, k, ids[at : at + 2048]) for k, at in enumerate(range(0, len(ids), 2048))]
    assert len(pieces) < 4096
    want = []
    for piece in sorted(pieces, key=lambda p: -len(p[2])):
        fits = [(2048 - sum(len(p[2]) for p in s), i) for i, s in enumerate(want) if sum(len(p[2]) for p in s) + len(piece[2]) <= 2048]
        if fits:
            want[max(fits, key=lambda f: (-f[0], f[1]))[1]].append(piece)
        else:
            want.append([piece])
    got = queries.op3_token_output(spark, sf_dir).orderBy("sequence_id").collect()
    assert len(got) == len(want) and sum(len(r.doc_ids) for r in got) == len(pieces)
    of = {(p[0], p[1]): p[2] for p in pieces}
    for r in got:
        ids, positions = np.frombuffer(r.ids, "<u4").tolist(), np.frombuffer(r.positions, "<u4").tolist()
        members = [of.pop(key) for key in zip(r.doc_ids, r.pieces, strict=True)]
        assert ids == sum(members, []) + [0] * (2048 - sum(map(len, members)))
        assert r.cu_seqlens == [sum(map(len, members[:i])) for i in range(len(members) + 1)]
        assert positions == [x for m in members for x in range(len(m))] + [0] * (2048 - r.cu_seqlens[-1])
    assert sorted(r.cu_seqlens[-1] for r in got) == sorted(sum(len(p[2]) for p in s) for s in want)
    assert not of


def test_ids_keep_their_type_and_rows_repeat(spark):
    docs = spark.createDataFrame([("x", "a b", 1, b"i"), ("x", "a b", 1, b"i"), (None, "c", 2, None)], "doc_id string, text string, pieces int, ids binary")
    (row,) = token_output.pack(docs.coalesce(1), PATH, 64).collect()
    assert sorted(row.doc_ids, key=str) == [None, "x", "x"] and row.pieces == [0, 0, 0]
