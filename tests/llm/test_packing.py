import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quern.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a\x1cb", "a\x85b", "a\xa0b", "Σας ΟΔΟΣ Σ", "é ́x", "a ́b", "<|endoftext|> x", "<|startoftext|>y <|end oftext|>", "<|ENDOFTEXT|>.", "İ ǅ", "I'll don't 's", "it's. I'LL, DON'T.", "x" * 500, "日本 語", "ﬁ", "\x00 \x01", "a\ń", "'\ns", "A. b, C, 1. 2,, x.. é. É, K."]


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return packing.encoder_of(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def raw(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(encoder, library, text):
    assert encoder.ids(text) == raw(library, text)


def test_ids_of_random_texts(encoder, library):
    rng = random.Random(2)
    letters = [*"abcÉéüßΣσ'  \n\t\x0b\x1c\x85\xa0́　.,12<|>日각", "'s", "'ll", "the", "<|endoftext|>"]
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 25)))
        assert encoder.ids(text) == raw(library, text), text


def test_ids_of_letter_words(encoder, library):
    assert encoder.merges is not None
    rng = random.Random(4)
    letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100), 0xAA, 0xB5, 0xBA, 0x131, 0x149) if c != 0xF7]
    for _ in range(20_000):
        text = "".join(rng.choice(letters[: rng.choice([26, 58, 63])]) for _ in range(rng.randint(1, 18)))
        assert encoder.ids(text) == raw(library, text), text


@pytest.mark.parametrize("text", ["H\u0331", "J\u030c", "T\u0308a W\u030a. Y\u030a, aH\u0331b", "The H\u0331amza OF Ibn J\u030cubayr, H. H\u0331.", "I\u0307 GR\u00d6SSE \u00c4rger A\u0308RGER"])
def test_capitals_before_marks(encoder, library, text):
    assert encoder.ids(text) == raw(library, text)


def test_capitals_before_marks_at_random(encoder, library):
    rng = random.Random(7)
    letters = [*"HTWYJAIShtwyj ., ", *map(chr, (0x300, 0x301, 0x307, 0x308, 0x30A, 0x30C, 0x331)), "É", "Σ"]
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 20)))
        assert encoder.ids(text) == raw(library, text), text


def test_a_tokenizer_that_keeps_case(library):
    spec = json.loads(library.to_str())
    spec["normalizer"] = {"type": "NFC"}
    kept = json.dumps(spec)
    assert packing.WordEncoder(kept.encode()).ids("The Cat SAT.") == raw(Tokenizer.from_str(kept), "The Cat SAT.") != raw(library, "The Cat SAT.")


def used(counts, capacity):
    """Checks a plan and gives the number of its sequences."""
    placements, n = packing.plan(counts, capacity)
    held, ranks = defaultdict(list), Counter()
    for p in placements:
        assert p.first_rank == ranks[p.length]
        ranks[p.length] += p.n
        for k in range(p.n):
            held[p.first_sequence + k // p.per].append((p.offset + k % p.per * p.length, p.length))
    assert +ranks == +Counter(counts) and set(held) == set(range(n))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return n


def best_fit(counts, capacity):
    rooms = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fits = [r for r in rooms if r >= length]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(60))
def test_plans_are_whole_and_close_to_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 20, 64, 100, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, rng.choice([2, 30])) for _ in range(rng.randint(0, 15))}
    assert used(counts, capacity) <= best_fit(counts, capacity) + 1


def test_configurations_beat_best_fit_where_it_fails():
    counts = {40: 400, 30: 400, 31: 400, 29: 400, 70: 400}  # 70+30, 40+31+29 and so on fill sequences of 100
    assert used(counts, 100) <= best_fit(counts, 100)
    made = packing.configurations([70, 40, 31, 30, 29], [400] * 5, 100)
    assert all(sum(s * n for s, n in zip([70, 40, 31, 30, 29], c, strict=True)) <= 100 for c, _ in made)
    assert sum(n for _, n in made) >= 700


def test_groups_have_equal_cardinality():
    made = packing.linear_groups({100: 7, 90: 5, 80: 9, 10: 50}, 50, 3)
    assert [sum(n for _, n in g) for g in made] == [7, 7, 7] and made[1] == [(90, 5), (80, 2)]


def test_impossible_lengths_are_refused():
    with pytest.raises(ValueError, match="lengths"):
        packing.plan({2049: 1})


def check(rows, texts, library, capacity):
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc_id, text in texts.items():
        ids = raw(library, text or "") + b"\0\0\0\0"
        got = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got)))
        assert [(r.start, r.length, r.ids_crc32) for r in got] == [(at // 4, len(ids[at : at + 4 * capacity]) // 4, zlib.crc32(ids[at : at + 4 * capacity])) for at in range(0, len(ids), 4 * capacity)]
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_documents(spark, library, sf_dir, capacity):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "doc_id AS length", "lang AS rank")
    extra = spark.createDataFrame([(10**6, None, 1, "x"), (10**6 + 1, "", 1, "x"), (10**6 + 2, "word " * 9000, 1, "x"), *((2 * 10**6 + i, "same words", 1, "x") for i in range(300))], docs.schema)
    both = docs.unionByName(extra)
    rows = packing.pack_documents(both, PATH, capacity).collect()
    n = check(rows, {r.doc_id: r.text for r in both.collect()}, library, capacity)
    assert n <= 1.02 * sum(r.length for r in rows) / capacity + 1


def test_repeated_and_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)], "doc_id long, text string")
    rows = packing.pack_documents(docs, PATH).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_plans_come_from_configurations():
    """Many lengths: as few sequences as tokens need, or one in a thousand more, most of them begun by configurations."""
    rng = random.Random(3)
    counts = Counter(min(2047, max(1, int(rng.lognormvariate(6.2, 0.9)))) for _ in range(8000))
    made = packing.planned(dict(counts))
    least = -(-sum(x * n for x, n in counts.items()) // 2048)
    assert made.n_sequences <= 1.001 * least + 1
    assert made.grouped > 0.2 * made.n_sequences
