"""URL filters: listed rules first, then gradient-boosted trees on lexical features for what no rule decides.

* A rule has a verdict, a host and the beginning of a path. It fits its host and all subdomains where the path begins so;
  of the rules that fit, the longest (host and path together) wins, of equally long ones the first.
* Features of a URL: its length and that of host and path, depth (segments of the path), labels of the host, share of
  digits, entropy of its characters, number of parameters, and statistics of its host's suffixes of one, two and three
  labels: how many URLs and hosts share the suffix, and which share of the labelled URLs under it is blocked.
* Suffix statistics are counted over all URLs and all labelled URLs, each distinct one once, by host first, so that the
  URLs of a large host meet in partial aggregates; they come back to the URLs over joins whose keys are salted. A labelled
  URL's own fold (one of four, by hash) is left out of the shares that the trees learn from.
* The trees are Spark ML's, trained on at most ``max_rows`` distinct labelled URLs (by hash, about that many). Everything
  else covers all rows.

Labelled URLs may come from anywhere; ``judge`` takes those that its rules decide, unless others are given.

Defined results: a null URL, or one without "://", has an empty host and path, fits no rule and is judged by the trees as
an empty text; a host keeps its port and user name; empty and very long URLs are measured whole; a URL that is labelled
both ways is learned both ways; repeated rows and ids are rows of their own; with labelled URLs of only one kind, all
that no rule decides get that kind, and with none they are allowed; extra columns are ignored, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of so many labels have statistics.
LEVELS = (1, 2, 3)
PER_SUFFIX = ("urls", "hosts", "labelled", "blocked")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules in use (fixed values).
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Params:
    """max_rows: distinct labelled URLs that trees learn from; trees, depth, step: of the boosting; prior: labelled URLs of
    even kinds that each suffix is given; folds: of labelled URLs; salts: parts of a hot host or suffix."""

    max_rows: int = 100_000
    trees: int = 20
    depth: int = 4
    step: float = 0.2
    prior: float = 4.0
    folds: int = 4
    salts: int = 16
    block_from: float = 0.5
    seed: int = 7


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):  # the last one asked is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def ruled(rows: DataFrame, rules: tuple[Rule, ...], url_col: str) -> DataFrame:
    """rows with host, path, rule and by_rule (the rule's verdict)."""
    host, path = parsed(F.col(url_col))
    with_parts = rows.withColumns({"host": host, "path": path})
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return with_parts.withColumns({"rule": name, "by_rule": verdict})


def entropy(text: Column) -> Column:
    """Bits a character; 0 for the empty text."""
    n = F.length(text)
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: n - F.length(F.replace(text, c, F.lit(""))))
    bits = F.aggregate(counts, F.lit(0.0), lambda s, k: s + F.when(k > 0, k * F.log2(k.cast("double"))).otherwise(0.0))
    return F.when(n > 0, F.log2(n.cast("double")) - bits / n).otherwise(0.0)


def lexical() -> dict[str, Column]:
    """Features of the columns url (not null), host and path."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    n = F.length(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    named = {
        "length": n,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")),
        "labels": F.size(F.filter(F.split(host, "[.]"), lambda s: s != "")),
        "digit_share": F.when(n > 0, F.length(F.regexp_replace(url, "[^0-9]", "")) / n).otherwise(0.0),
        "entropy": entropy(url),
        "parameters": F.size(F.filter(F.split(query, "[&;]"), lambda s: s != "")),
    }
    return {k: v.cast("double") for k, v in named.items()}


def suffixes(host: Column) -> Column:
    """The host's suffixes of each number of labels; a host with fewer labels is its own."""
    return F.array(*(F.substring_index(host, ".", -k) for k in LEVELS))


def salted(left: DataFrame, right: DataFrame, key: str, spread: Column, salts: int) -> DataFrame:
    """left joined to right, whose key is unique; a key's rows of left are dealt by spread."""
    dealt = left.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    copies = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copies.hint("merge"), [key, "salt"]).drop("salt")  # Spark judges copies by one of them, and would broadcast all


def fold(url: Column, params: Params) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(params.folds)).cast("int")


def suffix_statistics(urls: DataFrame, labelled: DataFrame, params: Params = Params()) -> DataFrame:
    """host and stats: for each level the numbers of PER_SUFFIX and those of labelled and blocked URLs by fold.

    urls: url. labelled: url, label (1: to be blocked). Hosts of both are there.
    """
    seen = urls.select(F.coalesce("url", F.lit("")).alias("url"), F.lit(None).cast("int").alias("label")).distinct()
    both = seen.unionByName(labelled.select("url", F.col("label").cast("int").alias("label")).distinct())
    known, blocked = F.col("label").isNotNull(), F.col("label") == 1
    folds = range(params.folds)
    by_host = (
        both.select(parsed(F.col("url"))[0].alias("host"), "label", fold(F.col("url"), params).alias("fold"))
        .groupBy("host")
        .agg(
            F.count_if(~known).alias("urls"),
            F.count_if(known).alias("labelled"),
            F.count_if(blocked).alias("blocked"),
            F.array(*(F.count_if(known & (F.col("fold") == i)) for i in folds)).alias("fold_labelled"),
            F.array(*(F.count_if(blocked & (F.col("fold") == i)) for i in folds)).alias("fold_blocked"),
        )
    )
    by_host = stored(by_host, "hosts")
    total = {k: F.sum(k).alias(k) for k in ("urls", "labelled", "blocked")}
    by_fold = [F.array(*(F.sum(F.col(k)[i]) for i in folds)).alias(k) for k in ("fold_labelled", "fold_blocked")]
    counts = by_host.withColumn("suffix", F.explode(F.array_distinct(suffixes(F.col("host"))))).groupBy("suffix").agg(*total.values(), F.count("*").alias("hosts"), *by_fold)
    asked = by_host.select("host", F.posexplode(suffixes(F.col("host"))).alias("level", "suffix"))
    found = salted(asked, counts, "suffix", F.col("host"), params.salts)
    kept = F.struct("level", *PER_SUFFIX, "fold_labelled", "fold_blocked")
    return found.groupBy("host").agg(F.array_sort(F.collect_list(kept)).alias("stats"))  # one of each level


def featured(rows: DataFrame, stats: DataFrame, params: Params, own_fold: bool) -> DataFrame:
    """rows (url, host and path among them) with features (a vector). With own_fold, labelled URLs of a row's fold are left out."""
    joined = salted(rows, stats, "host", F.col("url"), params.salts)
    made = lexical()
    for i, level in enumerate(LEVELS):
        s = F.col("stats")[i]
        labelled, blocked = s["labelled"], s["blocked"]
        if own_fold:
            at = fold(F.col("url"), params)
            labelled, blocked = labelled - F.get(s["fold_labelled"], at), blocked - F.get(s["fold_blocked"], at)
        made |= {
            f"urls_{level}": F.log2(s["urls"] + F.lit(1.0)),
            f"hosts_{level}": F.log2(s["hosts"] + F.lit(1.0)),
            f"blocked_{level}": (blocked + F.lit(params.prior / 2)) / (labelled + F.lit(params.prior)),
        }
    names = [f"f_{k}" for k in made]
    out = joined.withColumns({f"f_{k}": v for k, v in made.items()}).drop("stats")
    return VectorAssembler(inputCols=names, outputCol="features").transform(out).drop(*names)


@dataclass(frozen=True)
class Model:
    """Trees and suffix statistics, or the only kind that was labelled."""

    stats: DataFrame
    trees: GBTClassificationModel | None
    only: float


def train(labelled: DataFrame, urls: DataFrame, params: Params = Params()) -> Model:
    """A model from labelled URLs (url, label: 1 to be blocked), with the suffixes of these and of urls (url)."""
    marked = stored(labelled.select(F.coalesce("url", F.lit("")).alias("url"), F.col("label").cast("double").alias("label")).where("label IS NOT NULL").groupBy("url", "label").agg(F.count("*").alias("n")), "labelled")
    stats = stored(suffix_statistics(urls, marked, params), "suffixes")
    kinds = {r.label: r.n for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return Model(stats, None, next(iter(kinds), 0.0))
    share = min(1.0, params.max_rows / sum(kinds.values()))
    chosen = marked.where(F.pmod(F.xxhash64("url", F.lit(params.seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    host, path = parsed(F.col("url"))
    fitted = stored(featured(chosen.withColumns({"host": host, "path": path}), stats, params, own_fold=True).select("features", "label"), "features")
    boosting = GBTClassifier(labelCol="label", maxIter=params.trees, maxDepth=params.depth, stepSize=params.step, seed=params.seed)
    return Model(stats, boosting.fit(fitted), 0.0)


def score(rows: DataFrame, model: Model, params: Params = Params()) -> DataFrame:
    """rows (url, host and path among them; hosts as in the model's statistics) with score: how likely the URL is to be blocked."""
    rows = rows.withColumn("url", F.coalesce("url", F.lit("")))
    if model.trees is None:
        return rows.withColumn("score", F.lit(model.only))
    scored = model.trees.transform(featured(rows, model.stats, params, own_fold=False))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None, params: Params = Params(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row."""
    rows = ruled(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url")), rules, "url")
    if labelled is None:
        labelled = rows.where("by_rule IS NOT NULL").select("url", (F.col("by_rule") == "block").cast("int").alias("label"))
    scored = score(rows, train(labelled, rows.select("url"), params), params)
    verdict = F.coalesce("by_rule", F.when(F.col("score") >= params.block_from, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
