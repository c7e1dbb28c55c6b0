import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from quern.llm import sentencepiece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "\n", " \n", "\n ", "a\n b", "a \nb", "  a", "a  b   c    d", " " * 15, " " * 33 + "x" + " " * 31, "▁", "▁▁a", "<s>", "</s> x", "<0x0A>", "<unk>", "日本語 テスト 😀👍🏽", "\x00a", "\t\tx", "a\r\nb", "ﬁ Å", "12345 67", "x" * 300, "﻿hi", "ß" * 40, "\x85", "　 x", "é"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return sentencepiece_bpe.model_of(f.read())


def agree(model, library, text):
    ids = library.encode(text)
    assert model.encode(text) == ids, text
    assert model.decode(ids) == library.decode(ids), text


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(model, library, text):
    agree(model, library, text)


def test_random_texts(model, library):
    rng = random.Random(1)
    letters = [*"abcdeéüßñ  \n\n▁<>0123.,;日😀", "the", "ing", "  ", "\n ", "tion"]
    known = sorted(model.known)
    for _ in range(4000):
        agree(model, library, "".join(rng.choice(letters) for _ in range(rng.randint(1, 30))))
        agree(model, library, "".join(rng.choice(known) for _ in range(rng.randint(1, 20))))


def test_decodes_any_ids(model, library):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259)]) for _ in range(rng.randint(1, 12))]
        assert model.decode(ids) == library.decode(ids), ids


def test_backtracking_equals_merging(model):
    rng = random.Random(3)
    for _ in range(3000):
        text = "▁" * rng.randint(0, 1) + "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(1, 25)))
        assert model.encode_chunk(text) == model.merge(text)


def test_table(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "lang AS n_tokens", "lang AS input")
    extra = spark.createDataFrame([(None, None, "x", "y"), (0, "again", None, None), (-1, "z" * 200_000 + " " + "日" * 50_000, None, None)], docs.schema)
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepiece_bpe.digests(docs.unionByName(extra), PATH).collect())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in docs.unionByName(extra).collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id or 0, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want)
    some = docs.limit(20)
    texts = {r.doc_id: r.text for r in sentencepiece_bpe.decode(sentencepiece_bpe.encode(some, PATH), PATH).collect()}
    assert texts == {r.doc_id: library.decode(library.encode(r.text)) for r in some.collect()}
    assert sentencepiece_bpe.digests(docs.limit(0), PATH).count() == 0


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    with open(PATH, "rb") as f:
        spec.ParseFromString(f.read())
    spec.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="merge type"):
        sentencepiece_bpe.Model(spec.SerializeToString())
