"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; its failure is one bit of ``failures`` and what it measured is kept
beside it. A policy is a versioned set of bits, so changing a policy, comparing two of them or asking what a single
rule is worth (an ablation) needs only the ledger and no text.

Defined results: a null or empty text has no words, all measurements 0, and fails ``few_words`` alone; rows are
judged one by one, so ties, repeated rows and null ids pass through unchanged; texts of any length are measured whole,
and a task holds those of a slice of rows; extra columns are left out of the ledger and kept, whatever their names, where
documents are returned; an empty table gives an empty ledger, and an ablation without rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from quern.llm.common import fresh, map_slices

#: Bytes that separate words, and the symbols that count against a text (fixed values).
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_marks")


@dataclass(frozen=True)
class Rule:
    """A named rule; fails is SQL over the measurements, true where a document fails."""

    name: str
    fails: str


#: A rule's place is its bit. New rules go to the end; a bit is never given to another rule.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("upper_case", "n_upper > n_lower"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words"),
    Rule("exclamation", "2 * n_marks > n_words"),
)

#: Versioned policies: the rules that reject a document.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "repeated_lines", "upper_case", "word_length", "exclamation"),
}
CURRENT = 2


def mask(rules: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    at = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << at[r] for r in set(rules))


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a 3-word window that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode()
    words = raw.split()
    dense = raw.translate(None, SPACES)
    lines = [x for x in raw.split(b"\n") if x.translate(None, SPACES)]
    return (
        len(words),
        len(text) - (len(raw) - len(dense)),
        len(dense) - len(dense.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(dense) - len(dense.translate(None, UPPER)),
        len(dense) - len(dense.translate(None, UPPER.lower())),
        dense.count(b"!"),
    )


def _measured(docs: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """docs with a struct of the measurements and ``failures`` added, and that column's name, new to docs."""
    at, name = docs.columns.index(text_col), fresh(docs, "ledger")
    schema = to_arrow_schema(docs.schema)
    out = schema.append(pa.field(name, pa.struct([(m, pa.int64()) for m in MEASURES])))
    ddl = StructType([*docs.schema, StructField(name, StructType([StructField(m, LongType()) for m in MEASURES]))])

    def make():
        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = list(zip(*map(measure, batch.column(at).to_pylist()), strict=True))
            found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in rows], fields=list(out.field(name).type))
            return pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)), found], schema=out)

        return kernel

    found = map_slices(docs, out, ddl, make)
    failed = F.expr(" + ".join(f"if({in_struct(r.fails, name)}, {1 << i}L, 0L)" for i, r in enumerate(RULES)))
    # Without words nothing but few_words can be said of a text.
    failed = F.when(F.col(f"`{name}`.n_words") == 0, F.lit(mask(("few_words",))).cast("long")).otherwise(failed)
    return found.withColumn(name, F.col(f"`{name}`").withField("failures", failed)), name


def in_struct(rule: str, name: str) -> str:
    """A rule's SQL with its measurements read from a struct column."""
    return re.sub(r"\b[a-z]\w+\b", lambda m: f"`{name}`.{m[0]}" if m[0] in MEASURES else m[0], rule)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its id as doc_id, every measurement and ``failures``. One pass, no shuffle."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found, name = _measured(source, "text")
    return found.select("doc_id", f"{name}.*")


def apply_policy(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return entries.withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablation(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """What each rule of a policy is worth: rows it fails, rows it alone rejects, rows kept without it.

    Rows are first counted by bitmask, at most 2 to the number of rules, so the rest is independent of the input.
    """
    spark, bits = entries.sparkSession, mask(POLICIES[version])
    masks = entries.groupBy(F.col("failures").bitwiseAND(F.lit(bits)).alias("failed")).agg(F.count("*").alias("n"))
    rules = spark.createDataFrame([(r.name, 1 << i) for i, r in enumerate(RULES) if bits >> i & 1], "rule string, bit long")
    without = F.col("failed").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    n = F.col("n")
    return (
        masks.join(F.broadcast(rules))
        .groupBy("rule", "bit")
        .agg(
            F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, n).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("failed") == F.col("bit"), n).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(without, n).otherwise(0)).alias("n_kept_without"),
            F.sum(F.when(F.col("failed") == 0, n).otherwise(0)).alias("n_kept"),
        )
    )


def filter_documents(docs: DataFrame, text_col: str = "text", version: int = CURRENT) -> DataFrame:
    """The documents that the policy keeps, with all their columns.

    The verdict is made beside the row, not joined back, so repeated and null ids keep their own verdicts.
    """
    found, name = _measured(docs, text_col)
    kept = F.col(f"`{name}`.failures").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0
    return found.where(kept).select(*(F.col(f"`{c}`") for c in docs.columns))
