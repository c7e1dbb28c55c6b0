import collections
import re

import pytest

from quern.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in many for j in (i, i + 1, i + 2)}
    seen, repeated, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORDS.search(line):
            lines += 1
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeated, len(covered), lines, sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text), text.count("!"))


TEXTS = [None, "", " \n\t ", "a", "a b c a b c", "x x x x", "é ö \x1c \x85b", "l\nl\nl \n l", "#!<> & |", "a b c\nd\na b c\n\n" * 3, "A" * 1000, "w " * 30_000, "one two " * 60, "  x y"]


@pytest.mark.parametrize("text", TEXTS)
def test_measures(text):
    assert quality.measure(text) == brute(text)


def test_documents_and_extra_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "n_chars AS n_words", "lang AS ledger", "lang AS failures")
    got = {r.doc_id: r for r in quality.ledger(docs).collect()}
    for r in docs.collect():
        assert tuple(got[r.doc_id][m] for m in quality.MEASURES) == brute(r.text)
    kept = quality.apply_policy(quality.ledger(docs)).where("kept").count()
    filtered = quality.filter_documents(docs)
    assert filtered.columns == docs.columns and filtered.count() == kept


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


GOOD = " ".join(f"word{i}" for i in range(60))
BAD = {"few_words": "short text", "repeated_words": "one two three " * 40, "symbols": GOOD.replace(" ", "# "), "repeated_lines": "\n".join([f"w{i} x" for i in range(25)] + ["s"] * 60), "upper_case": GOOD.upper(), "word_length": " ".join(f"{i:02d}" for i in range(60)), "exclamation": GOOD.replace(" ", "! ")}


@pytest.mark.parametrize("rule", [r.name for r in quality.RULES])
def test_every_rule_has_its_bit(spark, rule):
    failures = quality.ledger(frame(spark, [(1, BAD[rule])])).first().failures
    assert failures & quality.mask((rule,))


def test_policies_ablation_and_odd_rows(spark):
    rows = [(1, GOOD), (1, GOOD), (None, GOOD), (2, None), (3, ""), *((10 + i, t) for i, t in enumerate(BAD.values()))]
    entries = quality.ledger(frame(spark, rows))
    assert sorted(map(str, (r.doc_id for r in quality.apply_policy(entries).where("kept").collect()))) == ["1", "1", "None"]
    assert quality.apply_policy(entries, 1).where("kept").count() >= 3
    assert {r.failures for r in entries.where("doc_id IN (2, 3)").collect()} == {quality.mask(("few_words",))}
    for version, names in quality.POLICIES.items():
        bits = quality.mask(names)
        masks = [r.failures & bits for r in entries.collect()]
        got = {r.rule: r for r in quality.ablation(entries, version).collect()}
        assert set(got) == set(names)
        for name in names:
            bit = quality.mask((name,))
            assert got[name].n_failed == sum(bool(m & bit) for m in masks)
            assert got[name].n_failed_alone == sum(m == bit for m in masks)
            assert got[name].n_kept_without == sum(not m & ~bit for m in masks)
            assert got[name].n_kept == sum(not m for m in masks)


def test_empty_table(spark):
    assert quality.ledger(frame(spark, [])).count() == 0 and quality.filter_documents(frame(spark, [])).count() == 0
