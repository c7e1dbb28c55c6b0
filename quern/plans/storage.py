"""Queries over sinks and what reads them back: CSV, JSON, partitioned and versioned tables, text reports, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import scalars
from quern.plans.registry import register
from quern.sources import sinks, tables
from quern.sources.tables import table

NATION = "n_nationkey int, n_name string, n_regionkey int"
NATION_SQL = "SELECT n_nationkey::INTEGER AS n_nationkey, n_name, n_regionkey::INTEGER AS n_regionkey FROM nation"


def nations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("int").alias("n_regionkey"))


@register("csv_round_trip", "SELECT doc_id, text FROM documents")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Texts with quotes, commas and line ends through CSV."""
    path = sinks.scratch(spark, "csv")
    sinks.write_csv(table(spark, d, "documents").select("doc_id", "text"), path, one_file=False)
    return tables.csv(spark, path, "doc_id long, text string")


@register("csv_optional", f"{NATION_SQL} UNION ALL SELECT -1, 'written: false', 0")
def csv_optional(spark: SparkSession, d: str) -> DataFrame:
    """A table that is written, and one that has no rows, is not written and reads as empty."""
    rows, here, there = nations(spark, d), sinks.scratch(spark, "csv"), sinks.scratch(spark, "csv")
    sinks.write_csv_if_any(rows, here)
    was = sinks.write_csv_if_any(rows.where("n_nationkey < 0"), there)
    found = tables.optional(spark, here, NATION).unionByName(tables.optional(spark, there, NATION))
    return found.unionByName(spark.range(1).select(F.lit(-1).alias("n_nationkey"), F.lit(f"written: {str(was).lower()}").alias("n_name"), F.lit(0).alias("n_regionkey")))


@register("json_round_trip", "SELECT count(*) AS customers, min(c_custkey) AS least, max(c_custkey) AS most FROM customer")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A summary of nested records through one JSON file."""
    path = sinks.scratch(spark, "json")
    extent = F.struct(F.min("c_custkey").alias("least"), F.max("c_custkey").alias("most"))
    sinks.write_summary(table(spark, d, "customer").agg(F.count("*").alias("customers"), extent.alias("extent")), path)
    return tables.optional(spark, path, "customers long, extent struct<least: long, most: long>", "json").select("customers", "extent.least", "extent.most")


@register("partitioned_round_trip", "SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def partitioned_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table in folders by a column's value, of which one is not read."""
    path = sinks.scratch(spark, "partitioned")
    sinks.write_partitioned(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, "o_orderstatus")
    return spark.read.parquet(path).where("o_orderstatus <> 'P'").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most"))


@register("versioned_rewrite", f"WITH n AS ({NATION_SQL}) SELECT *, 1 AS version FROM n UNION ALL SELECT n_nationkey, upper(n_name) || '*', n_regionkey, 2 FROM n WHERE n_regionkey <> 0")
def versioned_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """A step that reads a table and writes it anew: both versions stay whole."""
    root = sinks.scratch(spark, "versions")
    sinks.write_version(nations(spark, d), root)
    sinks.write_version(sinks.read_version(spark, root).where("n_regionkey <> 0").withColumn("n_name", F.concat(F.upper("n_name"), F.lit("*"))), root)
    old, new = (sinks.read_version(spark, root, n).withColumn("version", F.lit(n)) for n in sinks.versions(spark, root))
    return old.unionByName(new)


@register(
    "text_report",
    """WITH r AS (SELECT r_regionkey, r_name FROM region), w AS (SELECT greatest(11, max(length(r_regionkey::VARCHAR)))::INTEGER AS a, greatest(6, max(length(r_name)))::INTEGER AS b FROM r),
    l AS (SELECT 0 AS line, 'Regions' AS text UNION ALL SELECT 1, '=======' UNION ALL SELECT 2, '' UNION ALL SELECT 3, 'All' UNION ALL SELECT 4, '---' UNION ALL SELECT 5, rpad('r_regionkey', a, ' ') || '  ' || rpad('r_name', b, ' ') FROM w
    UNION ALL SELECT 5 + row_number() OVER (ORDER BY r_regionkey), rtrim(rpad(r_regionkey::VARCHAR, a, ' ') || '  ' || rpad(r_name, b, ' ')) FROM r, w) SELECT line::BIGINT AS line, text FROM l""",
)
def text_report(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a fixed width; a report is made of small tables."""
    text = sinks.render("Regions", {"All": table(spark, d, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")})
    return spark.createDataFrame(list(enumerate(text.rstrip("\n").split("\n"))), "line long, text string")


@register(
    "nested_without_records",
    "SELECT n_regionkey::INTEGER AS region, count(*) AS n, min(n_name) AS first_name, 'first_name,n' AS fields FROM nation GROUP BY 1",
)
def nested_without_records(spark: SparkSession, d: str) -> DataFrame:
    """Nested summaries of which the list of all records is dropped before they are kept."""
    summary = F.struct(F.min("n_name").alias("first_name"), F.count("*").alias("n"), F.collect_list(F.struct("n_nationkey", "n_name")).alias("all_records"))
    kept = nations(spark, d).groupBy(F.col("n_regionkey").alias("region")).agg(summary.alias("s")).withColumn("s", scalars.without_fields(F.col("s"), "all_records"))
    fields = ",".join(sorted(kept.schema["s"].dataType.names))
    return kept.select("region", "s.n", "s.first_name", F.lit(fields).alias("fields"))


@register(
    "time_texts",
    """SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, count(*) AS n, round(epoch(max(ts) - min(ts)) * '1000.0'::DOUBLE / count(*), 6) AS ms_each,
    (floor(epoch(max(ts) - min(ts)))::BIGINT // 3600) || ':' || lpad((floor(epoch(max(ts) - min(ts)))::BIGINT % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((floor(epoch(max(ts) - min(ts)))::BIGINT % 60)::VARCHAR, 2, '0') AS took FROM events GROUP BY 1""",
)
def time_texts(spark: SparkSession, d: str) -> DataFrame:
    """By kind of event: when the last one was, how long all took, and milliseconds an event."""
    seconds = F.unix_micros(F.max("ts").cast("timestamp")) / 1e6 - F.unix_micros(F.min("ts").cast("timestamp")) / 1e6
    found = table(spark, d, "events").groupBy("event_type").agg(F.max("ts").alias("last"), F.round(seconds, 6).alias("seconds"), F.count("*").alias("n"))
    return found.select(
        "event_type",
        scalars.timestamp_text(F.col("last")).alias("last_seen"),
        "n",
        F.round(scalars.milliseconds_each(F.col("seconds"), F.col("n")), 6).alias("ms_each"),
        scalars.hours_minutes_seconds(F.col("seconds")).alias("took"),
    )


@register("size_check", "SELECT n_regionkey::INTEGER AS n_regionkey, count(*) AS actual, 5::BIGINT AS expected, CASE WHEN count(*) = 5 THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM nation GROUP BY 1 UNION ALL SELECT 99, 0, 1, 'MISMATCH'")
def size_check(spark: SparkSession, d: str) -> DataFrame:
    """Rows by key against a table of expected numbers, one of a key that no row has."""
    wanted = table(spark, d, "region").select(F.col("r_regionkey").cast("int").alias("n_regionkey"), F.lit(5).cast("long").alias("expected"))
    other = spark.range(1).select(F.lit(99).alias("n_regionkey"), F.lit(1).cast("long").alias("expected"))
    return sinks.with_size_check(nations(spark, d), wanted.unionByName(other), "n_regionkey")
