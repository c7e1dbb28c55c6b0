"""Queries over labelled items: inspection, duplicates, manifest, splits, near duplicates and augmentation plans."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import draws, scalars
from quern.operators import augment, checks, duplicates, evaluation, inspection, master, ordinals, split, upkeep
from quern.plans import surrogates as s
from quern.plans.registry import register
from quern.sources import sinks
from quern.sources.tables import table

HASHES, PAIRS = f"WITH {s.HASHES_SQL}\n", f"WITH {s.HASHES_SQL}, {s.PAIRS_SQL}\n"
#: Bits that near duplicates may differ in where bands find them.
BANDED = 10
COUNTS = "count(*) AS total, count_if(status = 'valid')::BIGINT AS valid, count_if(status = 'unsupported')::BIGINT AS unsupported, count_if(status = 'corrupt')::BIGINT AS corrupt"


def with_items(sql: str) -> str:
    """A query over the items and all that is made of them; what begins with a comma adds tables first."""
    return (s.BASE_SQL.rstrip() if sql.startswith(",") else s.BASE_SQL) + sql


# --- inspection -----------------------------------------------------------------------------------------------------


@register("inspect_status_counts", with_items(f"SELECT corpus, {COUNTS} FROM items GROUP BY 1"))
def inspect_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return inspection.status_counts(s.items(spark, d))


@register(
    "inspect_class_stats",
    with_items(
        f"""SELECT corpus, klass, {COUNTS}, min(n_chars) FILTER (status = 'valid') AS min_size, max(n_chars) FILTER (status = 'valid') AS max_size,
        coalesce(string_agg(DISTINCT source, ',' ORDER BY source) FILTER (status = 'valid'), '') AS modes FROM items GROUP BY 1, 2"""
    ),
)
def inspect_class_stats(spark: SparkSession, d: str) -> DataFrame:
    return inspection.class_stats(s.items(spark, d))


@register(
    "inspect_corpus_summary",
    with_items(
        """SELECT corpus, count(*) AS classes, sum(n)::BIGINT AS valid, min(n) AS min_per_class, max(n) AS max_per_class, round(avg(n), 6) AS mean_per_class, round(stddev_pop(n), 6) AS std_per_class
        FROM (SELECT corpus, klass, count_if(status = 'valid')::BIGINT AS n FROM items GROUP BY 1, 2) GROUP BY 1"""
    ),
)
def inspect_corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    return inspection.corpus_summary(s.items(spark, d))


COMPARE_SQL = """by_class AS (SELECT klass, count_if(corpus = 'A' AND status = 'valid')::BIGINT AS first_count, count_if(corpus = 'B' AND status = 'valid')::BIGINT AS second_count FROM items GROUP BY 1
  HAVING count(DISTINCT corpus) = 2), common AS (SELECT *, first_count + second_count AS combined FROM by_class)"""


@register(
    "class_count_compare",
    f"WITH {s.ITEMS_SQL}, {COMPARE_SQL} SELECT klass, first_count, second_count, combined, CASE WHEN combined < 180 THEN 'WARN' ELSE 'OK' END AS flag FROM common "
    "UNION ALL SELECT 'TOTAL', sum(first_count)::BIGINT, sum(second_count)::BIGINT, sum(combined)::BIGINT, '' FROM common",
)
def class_count_compare(spark: SparkSession, d: str) -> DataFrame:
    return inspection.compare_counts(s.items(spark, d), s.FIRST, s.SECOND, 180)


@register(
    "combined_count_spread",
    f"WITH {s.ITEMS_SQL}, {COMPARE_SQL} SELECT sum(combined)::BIGINT AS total, min(combined) AS least, max(combined) AS most, round(avg(combined), 6) AS mean, round(coalesce(stddev_samp(combined), 0), 6) AS std_samp FROM common",
)
def combined_count_spread(spark: SparkSession, d: str) -> DataFrame:
    compared = inspection.compare_counts(s.items(spark, d), s.FIRST, s.SECOND, 180)
    return inspection.spread(compared.where("klass <> 'TOTAL'"), "combined")


@register(
    "class_set_diff",
    with_items(
        """SELECT source, CASE WHEN count(DISTINCT side) = 2 THEN 'both' WHEN min(side) = 1 THEN 'only_left' ELSE 'only_right' END AS side
        FROM (SELECT source, 1 AS side FROM items WHERE klass = 'es' UNION ALL SELECT source, 2 FROM items WHERE status = 'corrupt') GROUP BY 1"""
    ),
)
def class_set_diff(spark: SparkSession, d: str) -> DataFrame:
    items = s.items(spark, d)
    return inspection.set_difference(items.where("klass = 'es'"), items.where("status = 'corrupt'"), "source")


@register("class_corpus_pivot", with_items("SELECT klass, count_if(corpus = 'A')::BIGINT AS A, count_if(corpus = 'B')::BIGINT AS B FROM items GROUP BY 1"))
def class_corpus_pivot(spark: SparkSession, d: str) -> DataFrame:
    return s.items(spark, d).groupBy("klass").pivot("corpus", [s.FIRST, s.SECOND]).count().na.fill(0)


@register(
    "split_totals_check",
    with_items(
        """SELECT label, expected, actual, CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT 'train' AS label, 746::BIGINT AS expected, count_if(split = 'train')::BIGINT AS actual FROM split
        UNION ALL SELECT 'validation', 93, count_if(split = 'validation')::BIGINT FROM split UNION ALL SELECT 'classes', 4, count(DISTINCT klass) FROM split)"""
    ),
)
def split_totals_check(spark: SparkSession, d: str) -> DataFrame:
    rows = s.splits(spark, d)
    one = rows.agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "validation").alias("validation"), F.countDistinct("klass").alias("classes"))
    return checks.totals(one, {"train": 746, "validation": 93, "classes": 4})


@register(
    "snapshot_changes",
    with_items("SELECT klass, count(*) AS before, count_if(include_in_master)::BIGINT AS after, count(*) = count_if(include_in_master) AS unchanged FROM entries GROUP BY 1"),
)
def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = s.entries(spark, d)
    return checks.snapshot_changes(rows, rows.where("include_in_master"), "klass")


@register(
    "example_item",
    with_items("SELECT id, klass, corpus FROM items WHERE status = 'valid' ORDER BY klass <> 'fr', klass, corpus, id LIMIT 1"),
)
def example_item(spark: SparkSession, d: str) -> DataFrame:
    return s.items(spark, d).where("status = 'valid'").orderBy(F.col("klass") != "fr", "klass", "corpus", "id").limit(1).select("id", "klass", "corpus")


EXPECTED = [("items", 1000), ("first", 500), ("second", 500), ("unique", 927), ("classes", 4), ("nothing", 1)]
EXPECTED_SQL = ", ".join(f"('{k}', {v}::BIGINT)" for k, v in EXPECTED)


@register(
    "expectation_check",
    with_items(
        f"""SELECT e.label, e.expected, a.actual, a.actual - e.expected AS difference, CASE WHEN a.actual IS NOT DISTINCT FROM e.expected THEN 'MATCH' ELSE 'MISMATCH' END AS status
        FROM (VALUES {EXPECTED_SQL}) e(label, expected) LEFT JOIN (SELECT 'items' AS label, count(*) AS actual FROM items UNION ALL SELECT 'first', count_if(corpus = 'A')::BIGINT FROM items
        UNION ALL SELECT 'second', count_if(corpus = 'B')::BIGINT FROM items UNION ALL SELECT 'unique', count(DISTINCT fingerprint) FROM items UNION ALL SELECT 'classes', count(DISTINCT klass) FROM items) a USING (label)"""
    ),
)
def expectation_check(spark: SparkSession, d: str) -> DataFrame:
    one = s.items(spark, d).agg(
        F.count("*").alias("items"), F.count_if(F.col("corpus") == s.FIRST).alias("first"), F.count_if(F.col("corpus") == s.SECOND).alias("second"), F.countDistinct("fingerprint").alias("unique"), F.countDistinct("klass").alias("classes")
    )
    actual = one.unpivot([], ["items", "first", "second", "unique", "classes"], "label", "actual")
    return inspection.expectations(actual, spark.createDataFrame(EXPECTED, "label string, expected long"))


@register(
    "nonstandard_first_20",
    with_items("SELECT id, n_chars, greatest((SELECT count(*) FROM items WHERE n_chars > 5000) - 20, 0) AS more FROM items WHERE n_chars > 5000 ORDER BY id LIMIT 20"),
)
def nonstandard_first_20(spark: SparkSession, d: str) -> DataFrame:
    return inspection.first_and_rest(s.items(spark, d).where("n_chars > 5000").select("id", "n_chars"), ["id"], 20)


@register("ids_by_status", with_items("SELECT klass, coalesce(string_agg(id::VARCHAR, ',' ORDER BY id) FILTER (status = 'corrupt'), '') AS ids FROM items GROUP BY 1"))
def ids_by_status(spark: SparkSession, d: str) -> DataFrame:
    return inspection.ids_by_status(s.items(spark, d), "corrupt")


@register(
    "page_paths",
    """WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://', '') AS path FROM pages)
    SELECT page_id, list_extract(string_split(path, '/'), -1) AS name, list_extract(string_split(path, '/'), -2) AS folder, lower(regexp_extract(list_extract(string_split(path, '/'), -1), '.(\\.[^./]+)$', 1)) AS extension FROM p""",
)
def page_paths(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "^[a-z]+://", "")
    return table(spark, d, "pages").select("page_id", path.alias("path")).select("page_id", scalars.basename(F.col("path")).alias("name"), scalars.parent_name(F.col("path")).alias("folder"), scalars.suffix(scalars.basename(F.col("path"))).alias("extension"))


# --- exact duplicates -----------------------------------------------------------------------------------------------


@register("exact_dup_groups", with_items("SELECT * FROM found"))
def exact_dup_groups(spark: SparkSession, d: str) -> DataFrame:
    return s.groups(spark, d)


@register("exact_dup_members", with_items("SELECT fingerprint, dup_type, id, klass, corpus FROM items JOIN (SELECT fingerprint, dup_type FROM found) USING (fingerprint)"))
def exact_dup_members(spark: SparkSession, d: str) -> DataFrame:
    items = s.items(spark, d)
    return duplicates.members(items, duplicates.groups(items, s.FIRST, s.SECOND))


@register(
    "exact_dup_summary",
    with_items(
        """SELECT (SELECT count(*) FROM items) AS total, count(*) AS dup_groups, coalesce(sum(n - 1), 0)::BIGINT AS extra_copies, count_if(dup_type = 'cross-dataset')::BIGINT AS cross_groups,
        count_if(dup_type LIKE 'within%')::BIGINT AS within_groups, round(coalesce(sum(n - 1), 0) * 100.0::DOUBLE / (SELECT count(*) FROM items), 4) AS dup_pct FROM found"""
    ),
)
def exact_dup_summary(spark: SparkSession, d: str) -> DataFrame:
    items = s.items(spark, d)
    return duplicates.summary(items, duplicates.groups(items, s.FIRST, s.SECOND))


@register(
    "dup_type_by_source",
    with_items(
        """SELECT dup_type, count(*) AS dup_groups, sum(n - 1)::BIGINT AS extra_copies, sum(greatest(n_first - 1, 0))::BIGINT AS extra_in_first, sum(greatest(n_second - 1, 0))::BIGINT AS extra_in_second FROM found GROUP BY 1"""
    ),
)
def dup_type_by_source(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.extras_by_type(s.groups(spark, d))


@register("dup_instances_by_class", with_items("SELECT klass, count(*) AS n FROM items JOIN found USING (fingerprint) WHERE dup_type = 'cross-dataset' GROUP BY 1"))
def dup_instances_by_class(spark: SparkSession, d: str) -> DataFrame:
    items = s.items(spark, d)
    return duplicates.members(items, duplicates.groups(items, s.FIRST, s.SECOND)).where("dup_type = 'cross-dataset'").groupBy("klass").agg(F.count("*").alias("n"))


@register(
    "dup_verdict",
    s.BASE_SQL.rstrip()
    + f", {s.HASHES_SQL}, {s.PAIRS_SQL}, o AS (SELECT (SELECT count(*) FROM found WHERE dup_type = 'cross-dataset') AS cross_groups, (SELECT count(*) FROM pairs) AS near_pairs) "
    + "SELECT *, CASE WHEN cross_groups = 0 AND near_pairs = 0 THEN 'SAFE' WHEN near_pairs = 0 THEN 'CAUTION' ELSE 'WARNING' END AS verdict, cross_groups = 0 AND near_pairs = 0 AS safe_to_combine FROM o",
)
def dup_verdict(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.verdict(s.groups(spark, d), s.near(spark, d))


@register("label_conflicts", with_items("SELECT fingerprint, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS classes, count(DISTINCT source) AS n_classes FROM items WHERE fingerprint IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source) > 1"))
def label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Copies that several sources have; no copies of these tables differ in class."""
    return master.label_conflicts(s.items(spark, d).withColumn("klass", F.col("source")))


# --- manifest -------------------------------------------------------------------------------------------------------


@register("hash_cache_join", "SELECT doc_id AS id, sha256(text) AS fingerprint, doc_id % 2 = 0 AS from_cache FROM documents")
def hash_cache_join(spark: SparkSession, d: str) -> DataFrame:
    items = s.items(spark, d)
    return master.with_cached_hash(items, items.where("id % 2 = 0").select("id", "fingerprint")).select("id", "fingerprint", "from_cache")


@register("master_manifest", with_items("SELECT * FROM entries"))
def master_manifest(spark: SparkSession, d: str) -> DataFrame:
    return s.entries(spark, d)


@register("manifest_incremental", with_items("SELECT * FROM entries"))
def manifest_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The manifest after three deltas; the second brings in copies, some of them first in order, that the third removes."""
    root, rows = sinks.scratch(spark, "manifest"), s.items(spark, d)
    copies = rows.where("id % 10 = 0").withColumn("id", -F.col("id") - 1)
    upkeep.update(root, rows.where("id % 3 = 0"), s.ORDER)
    upkeep.update(root, rows.where("id % 3 = 1").unionByName(copies), s.ORDER)
    upkeep.update(root, rows.where("id % 3 = 2"), s.ORDER, copies.select("id"))
    return upkeep.current(spark, root)


@register("canonical_map", with_items("SELECT id, canonical_id FROM entries WHERE is_duplicate"))
def canonical_map(spark: SparkSession, d: str) -> DataFrame:
    return s.entries(spark, d).where("is_duplicate").select("id", "canonical_id")


@register("master_class_counts", with_items("SELECT klass, count_if(corpus = 'A')::BIGINT AS first_count, count_if(corpus = 'B')::BIGINT AS second_count, count(*) AS combined FROM entries WHERE include_in_master GROUP BY 1"))
def master_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return master.class_counts(s.entries(spark, d), s.FIRST, s.SECOND)


@register(
    "master_summary",
    with_items(
        """SELECT sum(n)::BIGINT AS total_master, count(*) AS classes, min(n) AS min_per_class, max(n) AS max_per_class, round(avg(n), 6) AS mean_per_class, round(coalesce(stddev_samp(n), 0), 6) AS std_per_class,
        (SELECT count(*) FROM entries) AS total_seen, (SELECT count_if(is_duplicate)::BIGINT FROM entries) AS duplicates, (SELECT count_if(NOT is_valid)::BIGINT FROM entries) AS invalid
        FROM (SELECT klass, count(*) AS n FROM entries WHERE include_in_master GROUP BY 1)"""
    ),
)
def master_summary(spark: SparkSession, d: str) -> DataFrame:
    return master.summary(s.entries(spark, d))


# --- splits ---------------------------------------------------------------------------------------------------------


@register("split_manifest", with_items("SELECT id, corpus, klass, split, fingerprint, n_chars, source FROM split"))
def split_manifest(spark: SparkSession, d: str) -> DataFrame:
    return s.splits(spark, d).select("id", "corpus", "klass", "split", "fingerprint", "n_chars", "source")


STATISTICS = "count_if(split = 'train')::BIGINT AS train_count, count_if(split = 'validation')::BIGINT AS validation_count, count_if(split = 'test')::BIGINT AS test_count, count(*) AS total_count"


@register("split_statistics", with_items(f"SELECT klass, {STATISTICS} FROM split GROUP BY 1"))
def split_statistics(spark: SparkSession, d: str) -> DataFrame:
    return split.statistics(s.splits(spark, d))


@register("split_shares", with_items("SELECT split, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM split), 4) AS share_pct FROM split GROUP BY 1"))
def split_shares(spark: SparkSession, d: str) -> DataFrame:
    return split.shares(s.splits(spark, d))


@register("split_rollup", with_items("SELECT CASE WHEN grouping(klass) = 1 THEN 'TOTAL' ELSE klass END AS klass, CASE WHEN grouping(split) = 1 THEN 'TOTAL' ELSE split END AS split, count(*) AS n FROM split GROUP BY ROLLUP (klass, split)"))
def split_rollup(spark: SparkSession, d: str) -> DataFrame:
    return split.rollup(s.splits(spark, d))


#: A split of all items, copies included, which therefore leaks.
CARELESS_SQL = """careless AS (SELECT *, CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'validation' ELSE 'test' END AS split FROM items),
leaks AS (SELECT fingerprint, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(DISTINCT split) AS n_splits, count(*) AS n FROM careless GROUP BY 1 HAVING count(DISTINCT split) > 1)"""


def careless(spark: SparkSession, d: str) -> DataFrame:
    part = F.when(F.col("id") % 10 < 8, "train").when(F.col("id") % 10 == 8, "validation").otherwise("test")
    return s.items(spark, d).withColumn("split", part)


@register("leakage_rows", f"WITH {s.ITEMS_SQL}, {CARELESS_SQL} SELECT * FROM leaks")
def leakage_rows(spark: SparkSession, d: str) -> DataFrame:
    return split.leaked(careless(spark, d))


LEAK_COUNTS = """SELECT count_if(splits LIKE '%train%' AND splits LIKE '%validation%')::BIGINT AS train_validation, count_if(splits LIKE '%train%' AND splits LIKE '%test%')::BIGINT AS train_test,
  count_if(splits LIKE '%validation%' AND splits LIKE '%test%')::BIGINT AS validation_test"""


@register("leakage_pairs", f"WITH {s.ITEMS_SQL}, {CARELESS_SQL}, o AS ({LEAK_COUNTS} FROM leaks) SELECT *, train_validation + train_test + validation_test > 0 AS leakage_found FROM o")
def leakage_pairs(spark: SparkSession, d: str) -> DataFrame:
    return split.leakage_counts(careless(spark, d))


LEAK_NONE = re.sub(r"(count_if\(.*?\))::BIGINT", r"coalesce(\1, 0)::BIGINT", LEAK_COUNTS)  # no rows: zeros


@register(
    "leakage_none",
    with_items(
        f", l AS (SELECT fingerprint, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM split GROUP BY 1 HAVING count(DISTINCT split) > 1), o AS ({LEAK_NONE} FROM l) SELECT *, train_validation + train_test + validation_test > 0 AS leakage_found FROM o"
    ),
)
def leakage_none(spark: SparkSession, d: str) -> DataFrame:
    return split.leakage_counts(s.splits(spark, d))


@register("leakage_semi", f"WITH {s.ITEMS_SQL}, {CARELESS_SQL} SELECT id, klass FROM careless WHERE split = 'train' AND fingerprint IN (SELECT fingerprint FROM careless WHERE split <> 'train')")
def leakage_semi(spark: SparkSession, d: str) -> DataFrame:
    rows = careless(spark, d)
    return split.leaked_rows(rows.where("split = 'train'"), rows.where("split <> 'train'")).select("id", "klass")


@register("leakage_filtered", f"WITH {s.ITEMS_SQL}, {CARELESS_SQL} SELECT id, klass FROM careless WHERE split = 'train' AND fingerprint IN (SELECT fingerprint FROM careless WHERE split <> 'train')")
def leakage_filtered(spark: SparkSession, d: str) -> DataFrame:
    """The same, with a filter over the held-out fingerprints before anything of the training side is shuffled."""
    rows = careless(spark, d)
    return split.leaked_rows_filtered(rows.where("split = 'train'"), rows.where("split <> 'train'")).select("id", "klass")


@register(
    "split_families",
    f"""WITH {s.ITEMS_SQL}, heads AS (SELECT fingerprint, min(id) AS id, arg_min(klass, id) AS klass FROM items GROUP BY 1),
    placed AS (SELECT *, row_number() OVER (PARTITION BY klass ORDER BY sha256('{s.SEED}|' || id), id) AS place, count(*) OVER (PARTITION BY klass) AS n FROM heads),
    sized AS (SELECT *, greatest(1, round_even(n * 0.1::DOUBLE, 0))::BIGINT AS v FROM placed),
    cut AS (SELECT fingerprint, CASE WHEN place <= CASE WHEN n - 2 * v < 1 THEN 1 ELSE n - 2 * v END THEN 'train'
      WHEN place <= CASE WHEN n - 2 * v < 1 THEN 1 ELSE n - 2 * v END + CASE WHEN n - 2 * v < 1 AND 2 * v > n - 1 THEN greatest(1, (n - 1) // 2) ELSE v END THEN 'validation' ELSE 'test' END AS split FROM sized)
    SELECT items.id, items.klass, cut.split FROM items JOIN cut USING (fingerprint)""",
)
def split_families(spark: SparkSession, d: str) -> DataFrame:
    return split.assign_families(s.items(spark, d), "fingerprint", s.SEED).select("id", "klass", "split")


NEED = f"(SELECT klass, count(*) AS n_orig, greatest({s.TARGET} - count(*), 0) AS n_needed FROM split WHERE split = 'train' GROUP BY 1)"


@register(
    "dataset_statistics",
    with_items(
        f"""SELECT c.klass, c.first_count, c.second_count, c.combined, coalesce(st.train_count, 0) AS train_count, coalesce(st.validation_count, 0) AS validation_count, coalesce(st.test_count, 0) AS test_count,
        coalesce(n.n_needed, 0) AS augmented_train_count, coalesce(n.n_orig + n.n_needed, 0) AS final_train_count
        FROM (SELECT klass, count_if(corpus = 'A')::BIGINT AS first_count, count_if(corpus = 'B')::BIGINT AS second_count, count(*) AS combined FROM entries WHERE include_in_master GROUP BY 1) c
        LEFT JOIN (SELECT klass, {STATISTICS} FROM split GROUP BY 1) st USING (klass) LEFT JOIN {NEED} n USING (klass)"""
    ),
)
def dataset_statistics(spark: SparkSession, d: str) -> DataFrame:
    """One pass: the split has the included items alone, so class, split and needed rows are counts of it; a missing count is 0."""
    rows = s.splits(spark, d)
    counts = rows.groupBy("klass").agg(
        F.count_if(F.col("corpus") == s.FIRST).alias("first_count"),
        F.count_if(F.col("corpus") == s.SECOND).alias("second_count"),
        F.count("*").alias("combined"),
        *(F.count_if(F.col("split") == x).alias(f"{x}_count") for x in split.SPLITS),
    )
    needed = F.when(F.col("train_count") > 0, F.greatest(F.lit(s.TARGET) - F.col("train_count"), F.lit(0))).otherwise(0)
    return counts.withColumn("augmented_train_count", needed.cast("long")).withColumn("final_train_count", F.col("train_count") + F.col("augmented_train_count"))


@register(
    "class_split_grid",
    with_items("SELECT k.klass, x.split, count(split.id) AS n FROM (SELECT DISTINCT klass FROM items) k CROSS JOIN (VALUES ('train'), ('validation'), ('test')) x(split) LEFT JOIN split ON split.klass = k.klass AND split.split = x.split GROUP BY 1, 2"),
)
def class_split_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every class with every split, whether or not it has items."""
    grid = s.items(spark, d).select("klass").distinct().withColumn("split", F.explode(F.array(*map(F.lit, split.SPLITS))))
    counts = s.splits(spark, d).groupBy("klass", "split").agg(F.count("*").alias("n"))
    return grid.join(counts, ["klass", "split"], "left").na.fill(0, ["n"])


@register(
    "global_size_extent",
    with_items("SELECT count(*) AS n, min(n_chars) AS least, max(n_chars) AS most, round(avg(n_chars), 6) AS mean FROM items WHERE status = 'valid'"),
)
def global_size_extent(spark: SparkSession, d: str) -> DataFrame:
    valid = s.items(spark, d).where("status = 'valid'")
    return valid.agg(F.count("*").alias("n"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.round(F.avg("n_chars"), 6).alias("mean"))


@register("fingerprint_prefixes", with_items("SELECT substr(fingerprint, 1, 16) AS prefix, n, dup_type FROM found"))
def fingerprint_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return s.groups(spark, d).select(F.substring("fingerprint", 1, 16).alias("prefix"), "n", "dup_type")


@register(
    "dataset_summary",
    with_items(
        """SELECT (SELECT count(*) FROM items) AS total_seen, (SELECT count(*) FROM found) AS dup_groups, (SELECT count_if(is_duplicate)::BIGINT FROM entries) AS duplicates, (SELECT count_if(include_in_master)::BIGINT FROM entries) AS total_master,
        (SELECT count(DISTINCT klass) FROM split) AS classes, (SELECT count_if(split = 'train')::BIGINT FROM split) AS train, (SELECT count_if(split = 'validation')::BIGINT FROM split) AS validation, (SELECT count_if(split = 'test')::BIGINT FROM split) AS test,
        (SELECT count(*) FROM (SELECT fingerprint FROM split GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS leaked"""
    ),
)
def dataset_summary(spark: SparkSession, d: str) -> DataFrame:
    """One row of five tables: items, duplicate groups, manifest, split and leakage."""
    rows = s.splits(spark, d)
    parts = [
        s.items(spark, d).agg(F.count("*").alias("total_seen")),
        s.groups(spark, d).agg(F.count("*").alias("dup_groups")),
        s.entries(spark, d).agg(F.count_if("is_duplicate").alias("duplicates"), F.count_if("include_in_master").alias("total_master")),
        rows.agg(F.countDistinct("klass").alias("classes"), *(F.count_if(F.col("split") == x).alias(x) for x in split.SPLITS)),
        split.leaked(rows).agg(F.count("*").alias("leaked")),
    ]
    out = parts[0]
    for part in parts[1:]:  # one row each
        out = out.join(F.broadcast(part))
    return out


# --- near duplicates ------------------------------------------------------------------------------------------------


@register("phash_bits", HASHES + "SELECT id, printf('%016x', CASE WHEN hash < 0 THEN hash::HUGEINT + (1::HUGEINT << 64) ELSE hash END) AS phash FROM hashes")
def phash_bits(spark: SparkSession, d: str) -> DataFrame:
    return s.hashes(spark, d).select("id", scalars.hash_hex(F.col("hash")).alias("phash"))


@register("dhash_bits", HASHES + "SELECT id, printf('%016x', dhash) AS dhash FROM hashes")
def dhash_bits(spark: SparkSession, d: str) -> DataFrame:
    return s.hashes(spark, d).select("id", scalars.hash_hex(F.col("dhash")).alias("dhash"))


@register("near_dup_pairs", PAIRS + "SELECT * FROM pairs")
def near_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    return s.near(spark, d)


FLIPPED = f"""{HASHES.rstrip()}, flipped AS (SELECT id, klass, xor(hash, (1::BIGINT << (id % 13)::INTEGER) - 1) AS hash FROM hashes)
    SELECT a.klass, a.id AS first_id, b.id AS second_id, bit_count(xor(a.hash, b.hash))::INTEGER AS distance FROM hashes a JOIN flipped b ON a.klass = b.klass AND bit_count(xor(a.hash, b.hash)) <= {BANDED}"""


def flipped(spark: SparkSession, d: str) -> DataFrame:
    """Items, and copies of which 0 to 12 bits are flipped as the second corpus."""
    first = s.hashes(spark, d).select("klass", F.lit(s.FIRST).alias("corpus"), "id", "hash", "fingerprint")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") % 13).cast("int")) - 1
    return first.unionByName(first.withColumn("corpus", F.lit(s.SECOND)).withColumn("hash", F.col("hash").bitwiseXOR(mask)).withColumn("fingerprint", F.concat("fingerprint", F.lit("*"))))


@register("near_dup_pairs_banded", FLIPPED)
def near_dup_pairs_banded(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.near_pairs_banded(flipped(spark, d), s.FIRST, s.SECOND, BANDED)


@register("near_dup_pairs_indexed", FLIPPED)
def near_dup_pairs_indexed(spark: SparkSession, d: str) -> DataFrame:
    """The same by neighbours in four bands of 16 bits, which pays for classes of a million hashes."""
    return duplicates.near_pairs_indexed(flipped(spark, d), s.FIRST, s.SECOND, BANDED, duplicates.bands_of(BANDED, 4))


@register("near_dup_by_class", PAIRS + "SELECT klass, count(*) AS pairs, count(DISTINCT first_id) AS first_items, count(DISTINCT second_id) AS second_items FROM pairs GROUP BY 1")
def near_dup_by_class(spark: SparkSession, d: str) -> DataFrame:
    return s.near(spark, d).groupBy("klass").agg(F.count("*").alias("pairs"), F.countDistinct("first_id").alias("first_items"), F.countDistinct("second_id").alias("second_items"))


@register("near_dup_histogram", PAIRS + "SELECT distance, count(*) AS n FROM pairs GROUP BY 1")
def near_dup_histogram(spark: SparkSession, d: str) -> DataFrame:
    return s.near(spark, d).groupBy("distance").agg(F.count("*").alias("n"))


@register("near_dup_first_50", PAIRS + "SELECT * FROM pairs ORDER BY klass, first_id, second_id LIMIT 50")
def near_dup_first_50(spark: SparkSession, d: str) -> DataFrame:
    return s.near(spark, d).orderBy("klass", "first_id", "second_id").limit(50)


@register(
    "near_dup_share",
    PAIRS
    + """SELECT (SELECT count(*) FROM hashes) AS total, count(*) AS pairs, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM hashes), 4) AS pairs_per_100_items,
    (SELECT count(DISTINCT x) FROM (SELECT first_id AS x FROM pairs UNION ALL SELECT second_id FROM pairs)) AS items_in_pairs FROM pairs""",
)
def near_dup_share(spark: SparkSession, d: str) -> DataFrame:
    pairs = s.near(spark, d)
    total = s.hashes(spark, d).agg(F.count("*").alias("total"))
    sides = pairs.select("first_id").unionAll(pairs.select("second_id")).agg(F.countDistinct("first_id").alias("items_in_pairs"), (F.count("*") / 2).cast("long").alias("pairs"))
    return total.join(F.broadcast(sides)).withColumn("pairs_per_100_items", F.round(scalars.percent(F.col("pairs"), F.col("total")), 4))


# --- augmentation ---------------------------------------------------------------------------------------------------

TRAIN_SQL = f""", train AS (SELECT *, row_number() OVER (PARTITION BY klass ORDER BY corpus, klass, id) - 1 AS r FROM split WHERE split = 'train'), need AS {NEED},
g AS (SELECT klass, n_orig, unnest(range(n_needed)) AS aug_index FROM need), plan AS (SELECT g.klass, g.aug_index, t.id AS source_id,
  xor(xor({s.SEED}::BIGINT, ('0x' || substr(md5(g.klass), 25))::BIGINT & 2147483647), g.aug_index * 6700417) AS random_seed, 'aug_' || g.klass || '_' || lpad(g.aug_index::VARCHAR, 6, '0') || '.png' AS generated_name
  FROM g JOIN train t ON t.klass = g.klass AND t.r = g.aug_index % g.n_orig)
"""


@register("augment_need", with_items(f"SELECT * FROM {NEED}"))
def augment_need(spark: SparkSession, d: str) -> DataFrame:
    return augment.need(s.train(spark, d), s.TARGET)


@register("augment_plan", s.BASE_SQL.rstrip() + TRAIN_SQL + "SELECT * FROM plan")
def augment_plan(spark: SparkSession, d: str) -> DataFrame:
    return s.plan(spark, d)


def parameters_sql() -> str:
    """SQL of the parameters of plan: five draws a seed, side by side."""
    drawn = draws.words_sql("(SELECT *, unnest(range(5)) AS place FROM plan)", "random_seed", "place")
    u = "any_value({u}) FILTER (place = {{}})".format(u=draws.uniform_sql()).format
    names = ("angle", "has_scale", "scale", "has_noise", "has_blur")
    side = ", ".join(f"{u(i)} AS u_{n}" for i, n in enumerate(names))

    def between(low: float, high: float, name: str) -> str:
        return f"round('{low!r}'::DOUBLE + '{high - low!r}'::DOUBLE * u_{name}, 6)"

    return f""", five AS (SELECT klass, aug_index, source_id, random_seed, generated_name, {side} FROM ({drawn}) GROUP BY ALL)
    SELECT klass, aug_index, source_id, random_seed, generated_name,
    'rotation' || CASE WHEN u_has_scale > 0.5 THEN '+scaling' ELSE '' END || CASE WHEN u_has_noise > 0.5 THEN '+noise' ELSE '' END || CASE WHEN u_has_blur > 0.5 THEN '+blur' ELSE '' END AS augmentation_type,
    {between(*augment.ROTATION, "angle")} AS rotation_angle, CASE WHEN u_has_scale > 0.5 THEN {between(*augment.SCALING, "scale")} ELSE 1.0::DOUBLE END AS scale_factor,
    CASE WHEN u_has_noise > 0.5 THEN {augment.NOISE_SIGMA}::DOUBLE ELSE 0.0::DOUBLE END AS noise_sigma, u_has_blur > 0.5 AS blur_applied FROM five"""


@register("augment_parameters", s.BASE_SQL.rstrip() + TRAIN_SQL.rstrip() + parameters_sql())
def augment_parameters(spark: SparkSession, d: str) -> DataFrame:
    return augment.with_parameters(s.plan(spark, d))


@register(
    "augment_counts",
    s.BASE_SQL.rstrip()
    + TRAIN_SQL
    + f"""SELECT CASE WHEN grouping(klass) = 1 THEN 'TOTAL' ELSE klass END AS klass, sum(o)::BIGINT AS original_count, sum(g)::BIGINT AS generated_count, sum(o + g)::BIGINT AS final_count,
    count(DISTINCT klass) * {s.TARGET} - sum(o + g)::BIGINT AS shortfall, CASE WHEN count(DISTINCT klass) * {s.TARGET} = sum(o + g) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT klass, 1 AS o, 0 AS g FROM train UNION ALL SELECT klass, 0, 1 FROM plan) GROUP BY ROLLUP (klass)""",
)
def augment_counts(spark: SparkSession, d: str) -> DataFrame:
    return augment.counts(s.train(spark, d), s.plan(spark, d), s.TARGET)


@register("augment_seed_repeats", s.BASE_SQL.rstrip() + TRAIN_SQL + "SELECT random_seed, count(*) AS n FROM plan GROUP BY 1 HAVING count(*) > 1")
def augment_seed_repeats(spark: SparkSession, d: str) -> DataFrame:
    return s.plan(spark, d).groupBy("random_seed").agg(F.count("*").alias("n")).where("n > 1")


@register("augment_combined", s.BASE_SQL.rstrip() + TRAIN_SQL + "SELECT klass, id::VARCHAR AS name, id AS source_id, NULL::BIGINT AS random_seed FROM train UNION ALL SELECT klass, generated_name, source_id, random_seed FROM plan")
def augment_combined(spark: SparkSession, d: str) -> DataFrame:
    return augment.combined(s.train(spark, d), s.plan(spark, d))


# --- positions without a single task --------------------------------------------------------------------------------


@register("scan_positions", with_items("SELECT id, corpus, klass, row_number() OVER (ORDER BY corpus, klass, id) - 1 AS position, row_number() OVER (PARTITION BY klass ORDER BY n_chars DESC, id) - 1 AS position_in_class FROM items"))
def scan_positions(spark: SparkSession, d: str) -> DataFrame:
    """Each item's position in the scan order of all, and by size in its class."""
    rows = s.items(spark, d).select("id", "corpus", "klass", "n_chars")
    placed = ordinals.within(ordinals.ordered(rows, *s.ORDER, name="position"), ["klass"], F.col("n_chars").desc(), "id", name="position_in_class")
    return placed.select("id", "corpus", "klass", "position", "position_in_class")


@register("size_ranks", with_items("SELECT id, n_chars, dense_rank() OVER (ORDER BY n_chars) - 1 AS size_rank FROM items"))
def size_ranks(spark: SparkSession, d: str) -> DataFrame:
    return ordinals.dense(s.items(spark, d).select("id", "n_chars"), "n_chars", name="size_rank")


@register(
    "positional_zip",
    with_items("SELECT coalesce(a.position, b.position) AS position, a.id AS first_id, b.id AS second_id FROM (SELECT id, row_number() OVER (ORDER BY n_chars, id) - 1 AS position FROM items WHERE corpus = 'A') a\n    FULL JOIN (SELECT id, row_number() OVER (ORDER BY n_chars DESC, id) - 1 AS position FROM items WHERE corpus = 'B') b ON a.position = b.position"),
)
def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    """The items of one corpus, by size, beside those of the other from the largest on."""
    rows = s.items(spark, d)
    first, second = (rows.where(F.col("corpus") == c).select(F.col("id").alias(f"{n}_id"), F.col("n_chars").alias(f"{n}_chars")) for c, n in ((s.FIRST, "first"), (s.SECOND, "second")))
    return ordinals.zipped(first, second, ["first_chars", "first_id"], [F.col("second_chars").desc(), "second_id"], name="position").select("position", "first_id", "second_id")


@register("size_quantiles", with_items(" UNION ALL ".join(f"SELECT klass, {q}::DOUBLE AS quantile, round(quantile_cont(n_chars::DOUBLE, {q}), 6) AS value FROM items GROUP BY klass" for q in (0.0, 0.05, 0.5, 0.9, 1.0))))
def size_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact quantiles of text sizes by class."""
    found = evaluation.quantiles(s.items(spark, d).select("klass", F.col("n_chars").cast("double").alias("n_chars")), "n_chars", [0.0, 0.05, 0.5, 0.9, 1.0], "klass")
    return found.withColumn("value", F.round("value", 6))


@register("id_pages", with_items("SELECT klass, page, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids FROM (SELECT klass, id, (row_number() OVER (PARTITION BY klass ORDER BY id) - 1) // 10 AS page FROM items WHERE status = 'corrupt') GROUP BY 1, 2"))
def id_pages(spark: SparkSession, d: str) -> DataFrame:
    return inspection.id_pages(s.items(spark, d), "corrupt", 10)


def permuted_sql() -> str:
    """SQL of the keyed split: a recursive query takes each position through the network until it lies in its range."""
    source = "(SELECT *, xx >> half AS high, xx & ((1 << half) - 1) AS low FROM (SELECT id, klass, n, half, key, x AS xx FROM walk WHERE NOT done))"
    for i in range(1, split.ROUNDS + 1):
        words = draws.words_sql(source, "key", "low", str(i))
        source = f"(SELECT id, klass, n, half, key, low AS high, xor(high, a & ((1 << half) - 1)) AS low FROM ({words}))"
    return f"""WITH RECURSIVE {s.ITEMS_SQL}, placed AS (SELECT id, klass, row_number() OVER (PARTITION BY klass ORDER BY id) - 1 AS x, count(*) OVER (PARTITION BY klass) AS n FROM items),
    start AS (SELECT id, klass, n, greatest(1, ceil(log2(greatest(n, 2)::DOUBLE) / 2))::INTEGER AS half, xor({s.SEED}::BIGINT, ('0x' || substr(md5(klass), 25))::BIGINT & 2147483647) AS key, x FROM placed),
    walk AS (SELECT id, klass, n, half, key, x, false AS done FROM start UNION ALL SELECT id, klass, n, half, key, y AS x, y < n AS done FROM (SELECT *, (high << half) | low AS y FROM {source})),
    sized AS (SELECT id, klass, n, x + 1 AS place, greatest(1, round_even(n * 0.1::DOUBLE, 0))::BIGINT AS v FROM walk WHERE done),
    cut AS (SELECT *, CASE WHEN n - 2 * v < 1 THEN 1 ELSE n - 2 * v END AS n_train, CASE WHEN n - 2 * v < 1 AND 2 * v > n - 1 THEN greatest(1, (n - 1) // 2) ELSE v END AS n_val FROM sized)
    SELECT id, klass, CASE WHEN place <= n_train THEN 'train' WHEN place <= n_train + n_val THEN 'validation' ELSE 'test' END AS split FROM cut"""


@register("split_permuted", permuted_sql())
def split_permuted(spark: SparkSession, d: str) -> DataFrame:
    """A split by a keyed permutation of each class."""
    return split.assign_permuted(s.items(spark, d).select("id", "klass"), s.SEED, ["id"]).select("id", "klass", "split")
