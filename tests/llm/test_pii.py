import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from test_near_duplicates import broadcast_joins

from quern.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def ok(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, r in BASE.items() for m in re.finditer(r, text or "", re.A) if ok(k, m[0])]


def texts():
    rng = random.Random(3)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "255.256.1.1", "+1 (578) 555-6437", "4111 1111 1111 1111", "4111-1111-1111-1112", "+", "é😀", " ", "  ", "\n", "x_y%z@d-e.fg.h", "0000000000000300.1.1.1", "12", "3", "-", "(", ")", "a@b", "..", "word"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(600)]
    return [None, "", " ", "a@b.c", "a@b.c@d.e", "a@b.c_x@d.e", "a@b.c.x@d.e", "1.2.3.4.5.6.7.8", "1.2.3", "4 1 1", "+1" + " " * 50, "+123456789", "9" * 40, "0.0.0.0 007.08.09.010", "\x00" * 3 + "a@b.co", *made]


def test_base_spans_match_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in pii.digests(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = brute(text)
        listed = [f"{k}:{s}:{e}" for k, s, e in want]
        assert got[i].base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), text
        assert set(listed) <= set(got[i].spans.split(",")) | {""}
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]


def planted():
    seeds = [f"call line +1 (578) 555-{1000 + i} today" for i in range(12)]
    plain = [f"the code {i}x{i} was seen" for i in range(40)]
    return [*seeds, *plain, "call line 578-555-9999 today", "call line 12 today", "the 578-555-8888 was", "é call line (578)555-7777, today"]


def test_confident_contexts_discover_unseen_identifiers(spark):
    rows = list(enumerate(planted()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digests(pii.find(df)).collect()}
    added = {i: [rows[i][1][int(s.split(":")[1]) : int(s.split(":")[2])] for s in got[i].spans.split(",")] for i in got if got[i].n_added}
    assert added == {52: ["578-555-9999"], 55: ["(578)555-7777"]}


def test_spaced_identifiers_are_discovered_and_redacted(spark):
    luhn_ok = ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "3000 0000 0000 04", "6011 0000 0000 0004", "2014 0000 0000 009", "3088 0000 0000 0009"]
    seeds = [f"call line +1 (578) 555-{1000 + i} today" for i in range(40)] + [f"paid by {c} then" for c in luhn_ok]
    unseen = {
        "call line 0171 555 1234 today": ["0171 555 1234"],
        "é call line (030) 123 4567, today": ["(030) 123 4567"],
        "call line 030 123.45-67 today": ["030 123.45-67"],
        "call line (030)123 4567 today and call line 0171 555 1235, today": ["(030)123 4567", "0171 555 1235"],
        "paid by 1234 5678 9012 then": ["1234 5678 9012"],
        "the 0171 555 1236 was": [],  # no confident context
        "call line 12 34 56 today": [],  # too few digits
        "call line " + "12 " * 20 + "today": [],  # too many
        "call line 0171 555 12a today": [],
        "call line 1 192.168.100.200 today": [],
    }
    rows = list(enumerate([*seeds, *unseen]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    base = {text: [f"{s}:{e}" for _, s, e in brute(text)] for _, text in rows}
    got = {}
    for r in pii.digests(pii.find(df)).collect():
        text = rows[r.doc_id][1]
        got[text] = [text[int(s) : int(e)] for _, s, e in (x.split(":") for x in r.spans.split(",") if x) if f"{s}:{e}" not in base[text]]
    assert {t: sorted(got[t]) for t in unseen} == {t: sorted(w) for t, w in unseen.items()}
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert [clean[i] for i, t in rows if t in list(unseen)[:5]] == ["call line <PHONE> today", "é call line <PHONE>, today", "call line <PHONE> today", "call line <PHONE> today and call line <PHONE>, today", "paid by <CARD> then"]


def test_words_of_any_length_are_contexts_as_a_whole(spark):
    same = "w" * 100
    one, other = "a" * 110 + same, "b" * 110 + same
    rows = list(enumerate([f"{one} x{i}@mail.org" for i in range(8)] + [f"{other} odd{i}@host" for i in range(2)] + [f"{one} odd{i}@host" for i in range(2, 4)]))
    got = {r.doc_id: r.n_added for r in pii.digests(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert {i for i, n in got.items() if n} == {10, 11}
    after = list(enumerate([f"z{i}@mail.org {one}" for i in range(8)] + [f"the odd{i}@host {other}" for i in range(2)]))
    assert pii.find(spark.createDataFrame(after, "doc_id long, text string")).where("size(added) > 0").count() == 0


def test_discovered_instances_are_seeds_of_the_next_round(spark):
    known = [f"call line +1 (578) 555-{1000 + i} today" for i in range(100)]
    unseen = [f"578-777-{1000 + i}" for i in range(20)]
    rows = list(enumerate([*known, *(f"call line {x} today" for x in unseen), *(f"then dial {x} now" for x in unseen), "then dial 578-999-1234 now"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_added for r in pii.digests(pii.find(df)).collect()}
    assert {i for i, n in got.items() if n} == set(range(100, 141))
    first = pii.Params(rounds=1)  # the second context has no seed of its own
    assert pii.find(df, first).where("size(added) > 0 AND doc_id >= 120").count() == 0


def test_one_word_beside_most_identifiers_is_salted_and_complete(spark):
    rows = [(i, f"line +1 (578) 555-{1000 + i % 9000} end") for i in range(400)] + [(1000 + i, f"line 578-555-{1000 + i} end") for i in range(20)]
    found = pii.digests(pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert found.where("doc_id >= 1000").agg(F.sum("n_added")).first()[0] == 20


def test_redaction_keeps_rows_columns_nulls_and_repeats(spark):
    rows = [(1, "mail a@b.c now", "x"), (1, "mail a@b.c now", "x"), (None, "ip 1.2.3.4", None), (2, None, "y"), (3, "", "z"), (4, "nothing here", "w"), (5, "4111 1111 1111 1111é", "q"), (6, "x@1.2.3.4", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    out = pii.redact(df)
    assert out.columns == df.columns
    got = sorted(map(tuple, out.collect()), key=str)
    want = sorted([(1, "mail <EMAIL> now", "x"), (1, "mail <EMAIL> now", "x"), (None, "ip <IP>", None), *rows[3:6], (5, "<CARD>é", "q"), (6, "<EMAIL>", None)], key=str)
    assert got == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(df).count() == 0 and pii.redact(df).count() == 0


@pytest.mark.parametrize("text", ["a" * 20_000 + "@", "1." * 20_000, "+1" * 50_000, "4" * 10_000, "a.b@" * 20_000, "1 " * 20_000])
def test_long_runs_end(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.digests(pii.find(df)).first()
    listed = [f"{k}:{s}:{e}" for k, s, e in brute(text)] if "+1+1" not in text else []
    assert got.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()


def test_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.base_sha256 for r in pii.digests(pii.find(docs)).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in brute(r.text)).encode()).hexdigest()


def test_salted_copies_of_spans_do_not_go_through_the_driver(spark):
    docs = spark.createDataFrame([(i, f"write to a{i}@b.cd today") for i in range(30)], "doc_id long, text string")
    out = []
    joins = broadcast_joins(spark, lambda: out.extend(pii.redact(docs).collect()))
    assert not joins[-1] and {r.text for r in out} == {"write to <EMAIL> today"}


def test_no_side_of_discovery_goes_through_the_driver(spark):
    rows = [(i, f"call me at +1 578 555 {1000 + i} or so") for i in range(60)] + [(100 + i, f"call me at 578 555 {1000 + i} or so") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = []
    joins = broadcast_joins(spark, lambda: out.extend(pii.digests(pii.find(docs)).collect()))
    assert joins and not any(joins)
    assert sum(r.n_added for r in out) == 5
