import math
import re
from collections import Counter

import numpy as np
import pytest

from quern.llm import lm_scoring
from quern.llm.lm_scoring import Params

#: One block a task, and a block for every few texts: the cuts must not change a score.
CUTS = [Params(), Params(block_bytes=5), Params(block_bytes=0)]


def brute(texts, leave_out):
    """Bigram scores of each text by the counts of all others, or of all."""
    pairs = [Counter(zip(["\0s", *w], w, strict=False)) for w in (re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for t in texts)]
    total, context, word = Counter(), Counter(), Counter()
    for p in pairs:
        for (u, v), n in p.items():
            total[u, v] += n
            context[u] += n
            word[v] += n
    everything = sum(word.values())
    out = []
    for p in pairs:
        own_u, own_v, s = Counter(), Counter(), 0.0
        for (u, v), n in p.items() if leave_out else ():
            own_u[u] += n
            own_v[v] += n
        others = everything - sum(own_v.values())
        for (u, v), n in p.items():
            seen = total[u, v] - (n if leave_out else 0)
            s += n * math.log(seen / (context[u] - own_u[u]) if seen else 0.4 * max(1, word[v] - own_v[v]) / max(1, others))
        out.append((sum(p.values()), s if p else None))
    return out


def same(got, want):
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] is None for g in got] == [w[2] is None for w in want]
    assert [g[2] for g in got if g[2] is not None] == pytest.approx([w[2] for w in want if w[2] is not None], abs=1e-5)


@pytest.mark.parametrize("leave_out", [True, False])
@pytest.mark.parametrize("cuts", CUTS)
def test_scores(spark, leave_out, cuts):
    params = Params(leave_out=leave_out, block_bytes=cuts.block_bytes)
    texts = ["a b a b c", "a b", "A b c", None, "", " \n", "z", "z z z", "the only one"]
    df = spark.createDataFrame([(i if i != 6 else None, t, i, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, n long, key long, w long")
    got = {r.doc_id: r for r in lm_scoring.score(df, params).collect()}
    same([(i, got[i if i != 6 else None].n_words, got[i if i != 6 else None].log_score) for i in range(len(texts))], [(i, *x) for i, x in enumerate(brute(texts, leave_out))])
    assert lm_scoring.score(df.limit(0), params).count() == 0


@pytest.mark.parametrize("cuts", CUTS)
def test_a_document_is_scored_by_the_others_alone(spark, cuts):
    own = " ".join(f"w{i} mine" for i in range(1000))  # a word of this document alone, after 1000 different words
    texts = ["a b a b c", "a b", "A b c b a", None, "", " \n", "z", "z z z", own, "w1 w2 w3 a b", "a b"]
    rows = [(i % 10, t) for i, t in enumerate(texts)]  # an id of two rows: the other row is not left out
    got = sorted((r.doc_id, r.n_words, r.log_score) for r in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cuts).collect() if r.n_words)
    same(got, sorted((i % 10, n, s) for i, (n, s) in enumerate(brute(texts, True)) if n))


@pytest.mark.parametrize("cuts", [Params(), Params(block_bytes=20_000)])
def test_whole_table(spark, sf_dir, cuts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    want = sorted((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows], True), strict=True))
    same(sorted((r.doc_id, r.n_words, r.log_score) for r in lm_scoring.score(docs, cuts).collect()), want)


def test_a_long_text_is_a_step_of_its_own(spark):
    texts = [" ".join(f"x{i % 9973}" for i in range(lm_scoring.STEP_WORDS + 1)), "x1 x2 x3", "x96 x0 y"]
    got = sorted((r.doc_id, r.n_words, r.log_score) for r in lm_scoring.score(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect())
    same(got, [(i, *x) for i, x in enumerate(brute(texts, True))])


def test_ids_keep_their_type_and_repeats_are_rows(spark):
    got = lm_scoring.score(spark.createDataFrame([("x", "a b"), ("x", "a b"), ("y", "b")], "doc_id string, text string"))
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    assert sorted(r.doc_id for r in got.collect()) == ["x", "x", "y"]


def test_one_text_alone(spark):
    r = lm_scoring.score(spark.createDataFrame([(1, "a a b")], "doc_id long, text string")).first()
    assert (r.n_words, r.log_score) == (3, pytest.approx(3 * math.log(0.4), abs=1e-5))


def brute_any(texts, order, backoff=0.4):
    """Scores of each text by the counts of all others, for n-grams of any length, straight from the definition."""
    lists = [["<s>", *(t or "").lower().split()] for t in texts]
    out = []
    for i, own in enumerate(lists):
        rest = [x for j, x in enumerate(lists) if j != i]
        grams = Counter(tuple(x[a : a + n]) for x in rest for n in range(1, order + 1) for a in range(len(x) - n + 1))
        contexts = Counter(tuple(x[a : a + n]) for x in rest for n in range(1, order) for a in range(len(x) - n))
        words = sum(len(x) - 1 for x in rest)
        s = 0.0
        for at in range(1, len(own)):
            weight = 1.0
            for n in range(min(order, at + 1), 0, -1):
                gram = tuple(own[at + 1 - n : at + 1])
                if n == 1:
                    s += math.log(weight * max(1, grams[gram]) / max(1, words))
                elif grams[gram]:
                    s += math.log(weight * grams[gram] / contexts[gram[:-1]])
                    break
                else:
                    weight *= backoff
        out.append((len(own) - 1, s if len(own) > 1 else None))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_longer_ngrams(spark, order):
    texts = ["a b c d a b c", "a b c e", "b c d a", "a", "", None, "c d a b c d x", "a b c d a b c"]
    got = lm_scoring.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), Params(order=order, block_bytes=9)).collect()
    same(sorted((r.doc_id, r.n_words, r.log_score) for r in got), [(i, *x) for i, x in enumerate(brute_any(texts, order))])


def test_packed_numbers():
    for x in ([], [0], [0, 0], [1, 2**64 - 1, 0, 7], list(range(1000))):
        assert lm_scoring.unpacked(lm_scoring.packed(np.array(x, np.uint64))).tolist() == x
