"""Personal data: exact base patterns, and contextual patterns bootstrapped from what they find.

Base kinds are found by regular expressions and checks (email, ip, card, phone). They are the seeds of the second
part: every identifier-like string, seed or not, is an instance, and the words beside it are its lexical patterns. The
graph of patterns and instances is scored in rounds:

* a pattern's confidence in a kind is the mean score of its distinct instances, one imagined failure included;
* an instance that is no seed scores what its best confident pattern says, and is a seed of the next round's patterns
  when that is as much as is asked of a pattern in the end.

Patterns that end with high confidence and enough distinct seeds of one kind give that kind to unseen instances beside
them, if these are of the kind's general make (an address with @, a number of digits). Base spans always stay. Words
are taken whole, however long.

All of it is DataFrame and SQL functions. One pass over the texts makes a narrow table of spans and instances, which
is stored; the graph is built from that. Edges are counted once each before anything is joined, and joins on patterns
are salted by instance, so a word that stands beside a third of all identifiers is no hot key.

Positions are code points, ends exclusive. The expressions start only at the beginning of a run of their characters
and give nothing back where that cannot matter, so their time is linear in the text.

Defined results: a null or empty text has no spans; equal texts have equal spans; an empty table, or one without
seeds, adds nothing; repeated rows count once as instances; extra columns are ignored or, where documents are
returned, kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stored

KINDS = ("email", "ip", "card", "phone")

# The base expressions, written so that no run is scanned from each of its characters.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Words end at these.
GAP = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
#: What may stand between two groups of digits: one blank, dot or hyphen, with a bracket before or after; the first dot of an ip does not.
JOIN = r"(?:\)[\x20-]?\(?|(?:[\x20-]|\.(?![0-9]++\.[0-9]++\.[0-9]))\(?|\()"
#: 7 to 19 digits in such groups, with the marks around them, that neither more digits nor letters go on from.
GROUPS = rf"(?<!{WORD})[^\x20\x09-\x0D0-9A-Za-z@+(]*+\(*+[0-9](?:{JOIN}?[0-9]){{6,18}}(?!{JOIN}?[0-9])[^\x20\x09-\x0D0-9A-Za-z@]*+(?!{WORD})"
#: Identifier-like: a phone, a card-like run of digits, groups of digits, or a word with a digit or @.
INSTANCE = rf"{PHONE}|(?<![0-9])[0-9](?:[\x20-]?[0-9]){{12,18}}(?![0-9])|{GROUPS}|(?<!{WORD})[^\x20\x09-\x0D0-9@]*+[0-9@]{WORD}*+"

#: Folds go by so many items.
STRETCH = 256

SPAN = "struct<kind:int,start:bigint,end:bigint>"


@dataclass(frozen=True)
class Params:
    rounds: int = 3
    min_seeds: int = 5
    confident: float = 0.6
    accepted: float = 0.8
    salts: int = 16


def _quoted(regex: str) -> str:
    """A regular expression as a raw SQL string."""
    return "r'" + regex + "'"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _valid(kind: str, x: str) -> str:
    """SQL: the match x of a kind's expression passes its check."""
    if kind == "email":
        return "true"
    if kind == "ip":
        part = "regexp_replace(p, '^0+', '')"
        return f"forall(split({x}, '[.]'), p -> length({part}) < 3 OR length({part}) = 3 AND {part} <= '255')"
    if kind == "card":
        return f"CASE WHEN length({_digits(x)}) BETWEEN 13 AND 19 THEN luhn_check({_digits(x)}) ELSE false END"
    return f"length({_digits(x)}) BETWEEN 9 AND 15"


def _fold(items: str, step: str, kind: str) -> str:
    """SQL: a fold over an array, from (s, x) to the next s of (at bigint, out array); gives the last out.

    It goes by stretches, whose results are joined at the end, so appending costs no square of the array's length.
    """
    inner = f"aggregate(c, CAST(struct(o.at AS at, array() AS out) AS struct<at:bigint,out:array<{kind}>>), (s, x) -> {step})"
    outer = f"get(transform(array({inner}), v -> struct(v.at AS at, concat(o.out, array(v.out)) AS out)), 0)"
    stretches = f"transform(sequence(0, CAST(size(z) DIV {STRETCH} AS int)), c -> slice(z, c * {STRETCH} + 1, {STRETCH}))"
    start = f"CAST(struct(0L AS at, array() AS out) AS struct<at:bigint,out:array<array<{kind}>>>)"
    return f"get(transform(array({items}), z -> aggregate({stretches}, {start}, (o, c) -> {outer}, o -> flatten(o.out))), 0)"


def _spans(kind: str, text: str) -> str:
    """SQL: the spans of a base kind. A fold over the matches and what stands before each keeps the position."""
    regex, hint = {"email": (EMAIL, "instr({t}, '@') > 0"), "ip": (IP, "{t} RLIKE '[0-9][.][0-9]'"), "card": (CARD, "{t} RLIKE '[0-9][ -]?[0-9]'"), "phone": (PHONE, "instr({t}, '+') > 0")}[kind]
    number, q = KINDS.index(kind), _quoted(regex)
    hits = f"zip_with(regexp_extract_all({text}, {q}, 0), split({text}, {q}, -1), (hit, gap) -> struct(hit, length(gap) AS gap, length(hit) AS n))"
    span = f"CAST(struct({number} AS kind, s.at + x.gap AS start, s.at + x.gap + x.n AS end) AS {SPAN})"
    step = f"CASE WHEN x.hit IS NULL THEN s ELSE struct(s.at + x.gap + x.n AS at, CASE WHEN {_valid(kind, 'x.hit')} THEN concat(s.out, array({span})) ELSE s.out END AS out) END"
    return f"CASE WHEN {hint.format(t=text)} THEN {_fold(hits, step, SPAN)} ELSE CAST(array() AS array<{SPAN}>) END"


def _kind_of(x: str) -> str:
    """SQL: the base kind of an identifier-like string, or null."""
    ip = f"regexp_extract({x}, {_quoted('(' + IP + ')')}, 1)"
    return (
        f"CASE WHEN {x} RLIKE {_quoted(EMAIL)} THEN 0 WHEN {ip} <> '' AND {_valid('ip', ip)} THEN 1 "
        f"WHEN {x} RLIKE {_quoted('^' + PHONE)} AND {_valid('phone', x)} THEN 3 "
        f"WHEN {x} RLIKE '^[^0-9]*[0-9]([ -]?[0-9]){{12,18}}[^0-9]*$' AND {_valid('card', x)} THEN 2 END"
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text), base (spans) and seen (instances in their contexts) of each row."""
    q, word = _quoted(INSTANCE), _quoted(GAP + "+")
    has = "text RLIKE '[0-9@]'"
    lead = "length(regexp_extract(h, '^([^A-Za-z0-9+(]*)', 1))"
    core = "regexp_replace(regexp_replace(h, '^[^A-Za-z0-9+(]+', ''), '[^A-Za-z0-9)]+$', '')"

    def words(gap: str, end: str, whole: int) -> str:
        """SQL: the words at an end of a gap, of which the first ones from there are whole. Most gaps are longer than needed."""
        some, split = f"{end}({gap}, 100)", f"filter(split({{}}, {word}), w -> w <> '')"
        return split.format(f"CASE WHEN size({split.format(some)}) > {whole} THEN {some} ELSE {gap} END")

    tail, head = words("get(gaps, i)", "right", 2), words("get(gaps, i + 1)", "left", 1)
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .withColumn("base", F.expr("concat(" + ", ".join(_spans(k, "text") for k in KINDS) + ")"))
        .withColumn("hits", F.expr(f"CASE WHEN {has} THEN regexp_extract_all(text, {q}, 0) ELSE CAST(array() AS array<string>) END"))
        .withColumn("gaps", F.expr(f"CASE WHEN {has} THEN split(text, {q}, -1) ELSE CAST(array() AS array<string>) END"))
        .withColumn("text_key", F.xxhash64("text"))
        .drop("text")
        .withColumn(
            "starts",
            F.expr(
                _fold(
                    "zip_with(hits, gaps, (h, g) -> struct(length(h) AS h, length(g) AS g))",
                    "CASE WHEN x.h IS NULL THEN s ELSE struct(s.at + x.g + x.h AS at, concat(s.out, array(s.at + x.g)) AS out) END",
                    "bigint",
                )
            ),
        )
        .withColumn("tails", F.expr(f"transform(hits, (h, i) -> {tail})"))
        .withColumn("heads", F.expr(f"transform(hits, (h, i) -> {head})"))
        .withColumn("cores", F.expr(f"transform(hits, h -> struct({core} AS instance, {lead} AS lead))"))
        .select(
            "doc_id",
            "text_key",
            "base",
            F.expr(
                "transform(cores, (c, i) -> struct(get(starts, i) + c.lead AS start, get(starts, i) + c.lead + length(c.instance) AS end, c.instance AS instance, "
                f"{_kind_of('c.instance')} AS kind, lower(try_element_at(get(tails, i), -1)) AS before, "
                "CASE WHEN size(get(tails, i)) > 1 THEN lower(concat(try_element_at(get(tails, i), -2), ' ', try_element_at(get(tails, i), -1))) END AS before2, "
                "lower(try_element_at(get(heads, i), 1)) AS after))"
            ).alias("seen"),
        )
    )


def contexts(scanned: DataFrame, *keys: str) -> DataFrame:
    """A row for each instance and each of its lexical patterns, with the given columns of its row."""
    one = scanned.select(*keys, F.explode("seen").alias("s")).where("s.instance <> ''")
    patterns = F.array(
        F.concat(F.lit("1 "), F.col("s.before")),
        F.concat(F.lit("2 "), F.col("s.before2")),
        F.concat(F.lit("3 "), F.col("s.before"), F.lit(" _ "), F.col("s.after")),
    )
    return one.select(*keys, "s.start", "s.end", "s.instance", "s.kind", F.explode(patterns).alias("pattern")).where("pattern IS NOT NULL")


def _salted(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int) -> DataFrame:
    """left joined to right on key, which is unique in right; each key's rows of left are dealt by another column.

    Spark judges the copies by the files they come from, so the merge is named: no side goes through the driver.
    """
    dealt = left.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    copies = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copies.hint("merge"), [key, "salt"]).drop("salt")


def score_patterns(edges: DataFrame, params: Params) -> DataFrame:
    """pattern, best (a kind), confidence, seeds: of distinct edges (pattern, instance, kind), after all rounds."""
    numbers = range(len(KINDS))
    counted = edges.groupBy("pattern").agg(F.count("*").alias("n"), *(F.count_if(F.col("kind") == k).alias(f"seeds_{k}") for k in numbers))
    counted = counted.where(F.col("n") >= params.min_seeds)  # others never have enough seeds
    unseen = edges.where("kind IS NULL").select("pattern", "instance")

    def scored(gained: DataFrame | None) -> DataFrame:
        table = counted if gained is None else counted.join(gained.hint("merge"), "pattern", "left")

        def with_gain(name: str, k: int):
            return F.col(f"seeds_{k}") + (F.lit(0) if gained is None else F.coalesce(F.col(f"{name}_{k}"), F.lit(0)))

        of = [F.struct((with_gain("gain", k) * F.lit(1.0)).alias("sum"), with_gain("new", k).alias("seeds"), F.lit(-k).alias("first")) for k in numbers]
        top = F.greatest(*of)
        return table.select("pattern", (-top["first"]).alias("best"), (top["sum"] / (F.col("n") + 1)).alias("confidence"), top["seeds"].alias("seeds"))

    patterns = scored(None)
    for _ in range(params.rounds - 1):
        sure = patterns.where((F.col("confidence") >= params.confident) & (F.col("seeds") >= params.min_seeds)).select("pattern", "best", "confidence")
        near = _salted(unseen, sure, "pattern", "instance", params.salts).where(_makes("best", "instance"))
        instances = near.groupBy("instance").agg(F.max(F.struct("confidence", (-F.col("best")).alias("first"))).alias("top")).select("instance", F.col("top.confidence").alias("score"), (-F.col("top.first")).alias("as_kind"))
        sums = [F.sum(F.when(F.col("as_kind") == k, F.col("score")).otherwise(0.0)).alias(f"gain_{k}") for k in numbers]
        new = [F.count_if((F.col("as_kind") == k) & (F.col("score") >= params.accepted)).alias(f"new_{k}") for k in numbers]
        patterns = scored(_salted(unseen, instances, "instance", "pattern", params.salts).groupBy("pattern").agg(*sums, *new))
    return patterns


def _makes(kind: str, x: str):
    """An unseen instance is of a kind's general make."""
    digits = _digits(x)
    return F.expr(
        f"CASE {kind} WHEN 0 THEN {x} RLIKE '^[^@]+@[^@]+$' WHEN 1 THEN {x} RLIKE '^[0-9A-Fa-f]*[.:][0-9A-Fa-f]*[.:][0-9A-Fa-f.:]+$' "
        f"WHEN 2 THEN {x} RLIKE '^[0-9 -]+$' AND length({digits}) BETWEEN 12 AND 19 ELSE {x} RLIKE '^[0-9+().-][0-9+(). -]+$' AND length({digits}) BETWEEN 7 AND 15 END"
    )


def discover(scanned: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """keys and added: the spans that confident patterns give to unseen instances. scanned is read several times."""
    edges = stored(contexts(scanned).select("pattern", "instance", "kind").distinct(), "edges")
    good = score_patterns(edges, params).where((F.col("confidence") >= params.accepted) & (F.col("seeds") >= params.min_seeds)).select("pattern", "best")
    open_ = contexts(scanned, *keys).where("kind IS NULL").drop("kind")
    hits = _salted(open_, good, "pattern", "instance", params.salts).where(_makes("best", "instance"))
    once = hits.groupBy(*keys, "start", "end").agg(F.min("best").alias("kind"))
    return once.groupBy(*keys).agg(F.collect_list(F.struct(F.col("kind").cast("int").alias("kind"), "start", "end")).alias("added"))


def find(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, base and added spans (kind, start, end) of each row, each in order of kind and start."""
    scanned = stored(scan(docs, id_col, text_col).withColumn("row_id", F.monotonically_increasing_id()), "scanned")
    found = scanned.select("row_id", "doc_id", "text_key", "base").join(discover(scanned.where("size(seen) > 0"), ["row_id"], params).hint("merge"), "row_id", "left")
    return found.select("doc_id", "text_key", F.array_sort("base").alias("base"), F.array_sort(F.coalesce("added", F.expr(f"CAST(array() AS array<{SPAN}>)"))).alias("added"))


def listed(spans: str) -> str:
    """SQL: spans as kind:start:end, joined by commas."""
    kind = "element_at(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), s.kind + 1)"
    return f"array_join(transform({spans}, s -> concat_ws(':', {kind}, s.start, s.end)), ',')"


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, and all spans."""
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(listed("base")), 256).alias("base_sha256"),
        F.expr(listed("array_sort(concat(base, added))")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span of every text replaced by its kind in brackets; what two spans share goes to the first.

    Only rows that may hold a span, those with a digit or @, are joined to what was found in them, by id and text.
    """
    columns = docs.columns
    text = F.col(f"`{text_col}`")
    may = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    held = docs.where(may)
    found = find(held, params, id_col, text_col).where("size(base) + size(added) > 0").select(F.col("doc_id").alias("q_id"), F.col("text_key").alias("q_key"), "base", "added").dropDuplicates(["q_id", "q_key"])
    spans = found.select("q_id", "q_key", F.expr("array_sort(transform(concat(base, added), s -> struct(s.start, s.end, s.kind)))").alias("q_spans"))
    merged = F.expr(
        _fold(
            "q_spans",
            "CASE WHEN x.end <= s.at THEN s ELSE struct(x.end AS at, concat(s.out, array(struct(greatest(x.start, s.at) AS start, x.end AS end, x.kind AS kind))) AS out) END",
            "struct<start:bigint,end:bigint,kind:int>",
        )
    )
    name = "element_at(array(" + ", ".join(f"'<{k.upper()}>'" for k in KINDS) + "), s.kind + 1)"
    parts = f"transform(q_spans, (s, i) -> concat(substring(q_text, CAST(CASE WHEN i = 0 THEN 0 ELSE get(q_spans, i - 1).end END + 1 AS int), CAST(s.start - CASE WHEN i = 0 THEN 0 ELSE get(q_spans, i - 1).end END AS int)), {name}))"
    clean = F.expr(f"CASE WHEN q_spans IS NULL THEN q_text ELSE concat(array_join({parts}, ''), substring(q_text, CAST(element_at(q_spans, -1).end + 1 AS int))) END")
    # Rows that repeat one id and text are dealt by where they are read.
    salt = F.pmod(F.spark_partition_id(), F.lit(params.salts)).alias("d_salt")
    row = held.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("q_row"), F.col(f"`{id_col}`").alias("d_id"), F.xxhash64(text).alias("d_key"), text.alias("q_text"), salt)
    copies = spans.withColumn("q_spans", merged).withColumn("q_salt", F.explode(F.sequence(F.lit(0), F.lit(params.salts - 1))))
    same = F.col("d_id").eqNullSafe(F.col("q_id")) & (F.col("d_key") == F.col("q_key")) & (F.col("d_salt") == F.col("q_salt"))
    joined = row.join(copies.hint("merge"), same, "left").withColumn("q_clean", clean)  # Spark judges copies by one of them, and would broadcast all
    done = joined.select(*(F.col("q_clean").alias(c) if c == text_col else F.col(f"q_row.`{c}`").alias(c) for c in columns))
    return docs.where(~may).unionByName(done)
