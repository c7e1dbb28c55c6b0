"""The pipeline's stages against brute force, each on what the stage before it kept."""

from collections import defaultdict

import pytest
import test_near_duplicates as near
import test_packing as packed
import test_pii as private
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quern.llm import quality, toxicity

ODD = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "short"), (10**6 + 3, "mail a@b.example and " + " ".join(f"plain{i}" for i in range(80))), (10**6 + 3, "mail a@b.example and " + " ".join(f"plain{i}" for i in range(80)))]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "src0", 1) for i, t in ODD], docs.schema))
    out, base = [docs], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], sf_dir).write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
    return [(df.columns, df.collect()) for df in out]


def test_all_stages_but_the_last_keep_the_columns(stages):
    assert all(columns == stages[0][0] for columns, _ in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "personal_data", "best_fit_packing"]


def test_quality(stages):
    bits = quality.mask(quality.POLICIES[quality.CURRENT])

    def fails(text):
        m = dict(zip(quality.MEASURES, quality.measure(text), strict=True))
        return not m["n_words"] or any(eval(r.fails.replace("OR", "or"), {}, m) for i, r in enumerate(quality.RULES) if bits >> i & 1)  # noqa: S307

    assert sorted(map(tuple, stages[1][1])) == sorted(tuple(r) for r in stages[0][1] if not fails(r.text))


def test_toxicity(stages, spark):
    kept = {r.doc_id for r in stages[2][1]}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    before = [r.doc_id for r in stages[1][1] if r.doc_id in labels]
    clean, toxic = [i for i in before if not labels[i]], [i for i in before if labels[i]]
    assert sum(i in kept for i in clean) / len(clean) > 0.97
    assert sum(i not in kept for i in toxic) / len(toxic) > 0.8
    assert toxicity.THRESHOLD == 0.7


def test_near_duplicates(stages):
    rows = [(r.doc_id, r.text) for r in stages[2][1]]
    want = {c for _, _, c in near.brute(rows, 5)}
    assert sorted(r.doc_id for r in stages[3][1]) == sorted(want)


def test_personal_data(stages):
    before = {r.doc_id: r for r in stages[3][1]}
    assert {r.doc_id for r in stages[4][1]} == set(before)
    for r in stages[4][1]:
        text, at, out = before[r.doc_id].text, 0, []
        for start, end, kind in sorted((s, e, list(private.BASE).index(k)) for k, s, e in private.brute(text)):
            if end > at:
                out += [text[at : max(start, at)], f"<{list(private.BASE)[kind].upper()}>"]
                at = end
        assert r.text == "".join(out) + text[at:]
        assert r.n_chars == len(r.text)


def test_packing(stages):
    texts = {r.doc_id: r.text for r in stages[4][1]}
    n = packed.check(stages[5][1], texts, Tokenizer.from_file(packed.PATH), 2048)
    assert n <= 1.02 * sum(r.length for r in stages[5][1]) / 2048 + 1
    assert len(defaultdict(list, {r.doc_id: r for r in stages[5][1]})) == len(texts)


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


CLASHING = ["ledger", "score", "drop_id", "drop_key", "again", "q_row", "q_text", "d_id", "node", "base", "row_id", "salt", "key", "piece"]


def test_columns_with_clashing_names_and_no_documents(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({c: F.lit(c) for c in CLASHING})
    for n, some in (("some", docs), ("none", docs.limit(0))):
        plain = some.drop(*CLASHING)
        for name, stage in corpus_pipeline.STAGES:
            for kind, df in (("with", some), ("plain", plain)):
                stage(spark, df, sf_dir).write.parquet(f"{tmp_path}/{n}-{name}-{kind}")
            some, plain = (spark.read.parquet(f"{tmp_path}/{n}-{name}-{kind}") for kind in ("with", "plain"))
            if name != "best_fit_packing":
                assert some.columns == docs.columns
                assert some.where(" OR ".join(f"`{c}` <> '{c}'" for c in CLASHING)).count() == 0
            assert sorted(r.doc_id for r in some.collect()) == sorted(r.doc_id for r in plain.collect())
        assert (some.count() == 0) == (n == "none")
