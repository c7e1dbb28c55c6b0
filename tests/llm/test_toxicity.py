import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import queries, toxicity


def test_risk_gradient_is_the_risks_slope():
    rng = np.random.default_rng(1)
    for prior in (0.1, 0.4):
        zp, zu = rng.normal(0, 1, 5), rng.normal(2, 1, 9)  # the negative part is positive
        risk, dp, du = toxicity.risk_gradient(zp, zu, prior)
        for z, d, place in ((zp, dp, 0), (zu, du, 1)):
            for i in range(len(z)):
                moved = z.copy()
                moved[i] += 1e-6
                other = toxicity.risk_gradient(*((moved, zu) if place == 0 else (zp, moved)), prior)[0]
                assert (other - risk) / 1e-6 == pytest.approx(d[i], abs=1e-5)


def test_a_negative_part_below_zero_is_turned_round():
    zp, zu = np.full(4, 3.0), np.full(6, -5.0)
    risk, dp, du = toxicity.risk_gradient(zp, zu, 0.5)
    assert risk == pytest.approx(0.5 * (1 - 1 / (1 + np.exp(-3))))
    assert (du < 0).all() and (dp > 0).all()


def corpus(spark, n=600):
    rng = random.Random(5)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words, toxic = rng.choices(plain, k=rng.randint(10, 60)), i % 6 == 0
        if toxic:
            words[:3] = rng.choices(["vile", "brutex", "brutan", "rotten"], k=3)
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_from_positives_and_unlabelled_texts(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels)
    assert model.prior == pytest.approx(1 / 3, abs=0.01)
    rows = toxicity.score(docs, model).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum((r.score >= 0.7) == (r.doc_id % 6 == 0) for r in rows) / len(rows) > 0.97
    again = toxicity.score(docs.repartition(7), toxicity.train(docs.repartition(5), labels.repartition(3))).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


def test_defined_results(spark):
    docs, labels = corpus(spark, 120)
    odd = docs.unionByName(spark.createDataFrame([(None, "vile"), (900, None), (901, ""), (0, "repeated id")], docs.schema))
    strange = labels.unionByName(spark.createDataFrame([(None, 1), (5000, 1), (4, None), (0, 1), (0, 0)], labels.schema))
    model = toxicity.train(odd, strange)
    got = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert got[900] == got[901] == pytest.approx(1 / (1 + np.exp(-model.bias)))
    none = toxicity.train(docs, labels.withColumn("toxic", F.lit(0)))
    assert toxicity.score(docs, none).agg(F.max("score")).first()[0] < 1e-9
    assert toxicity.train(docs, labels.limit(0)).weights == {} and toxicity.train(docs.limit(0), labels).weights == {}
    assert toxicity.score(docs.limit(0), model).count() == 0
    kept = toxicity.filter_documents(docs.withColumn("score", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "score"]


def test_sample_is_bounded(spark):
    docs, labels = corpus(spark)
    pos, unl = toxicity.sample(docs, labels, toxicity.Params(max_positive=7, max_unlabelled=11))
    assert (len(pos), len(unl)) == (7, 11)


def test_a_repeated_id_does_not_grow_the_sample(spark, monkeypatch):
    docs, labels = corpus(spark)
    many = docs.unionByName(spark.range(5000).selectExpr("0L AS doc_id", "concat('vile ', id) AS text")).unionByName(spark.range(5000).selectExpr("1L AS doc_id", "'calm' AS text"))
    sent, kind, collect = [], type(docs), type(docs).collect
    monkeypatch.setattr(kind, "collect", lambda self: sent.append(collect(self)) or sent[-1])
    pos, unl = toxicity.sample(many, labels, toxicity.Params(max_positive=7, max_unlabelled=11))
    assert (len(pos), len(unl), [len(x) for x in sent]) == (7, 11, [18])
    everything = toxicity.sample(many, labels, toxicity.Params())
    assert sum(map(len, everything)) == docs.select("doc_id").distinct().count()


def test_scores_equal_brute_force_on_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = queries.toxicity_model(spark, sf_dir, docs)
    assert model.weights
    got = {r.doc_id: r.score for r in queries.op1_toxicity(spark, sf_dir).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        z = model.bias
        for word in set((r.text or "").lower().split()):
            core = word.strip(toxicity.STRIP)
            for part in [core, *(core[:n] + "\0" + str(n) for n in (4, 5) if len(core) >= n)] if core else []:
                z += model.weights.get(zlib.crc32(part.encode()) % (1 << 24), 0.0)
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))), abs=1e-9)


def test_query_scores_held_out_rows_well(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op1_toxicity(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.85
    assert got.where("predicted NOT IN (0, 1) OR (score >= 0.7) <> (predicted = 1)").count() == 0
