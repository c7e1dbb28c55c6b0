"""MinHash near duplicates by a signature-coordinate inverted join.

A document's set is its distinct word shingles (64-bit fingerprints). Its signature has one minimum per coordinate; two
sets agree in a coordinate with the probability of their Jaccard similarity. Documents are posted under each
(coordinate, value) pair, and pairs that agree in at least ``matches`` coordinates are confirmed on the full sets:

1. Equal sets become one node, so groups of copies cost one posting however large they are.
2. Prefix and skip merging: two nodes with ``matches`` of k coordinates in common share one of any k - matches + 1.
   Each node is posted under its rarest so many pairs alone, so lists of common values are never merged.
3. Lists are cut by the sets' sizes, which must be within the least similarity of each other. A list is then known by
   its least node. All lists with the same one are joined into one group, so a family of near copies, which shares
   many lists, is met a few times and not once a list.
4. Groups are cut into tiles of bounded weight, by a hash. Every tile of a group also gets the group's few pivots. A
   tile counts the collisions of its nodes in numpy and passes on those nodes that have a partner with enough of them:
   rows grow with nodes, not with pairs.
5. For these the full sets are made again from the texts, and tiles confirm links: the intersections of a node with
   all others come from an inverted index of shingles at once, first for the node with most partners, then for every
   node that is not in the largest component so far. No link between two components of a tile remains untried, and a
   tile returns stars, not pairs.
6. Components come from alternating large-star and small-star steps. In a group of several tiles, two nodes of one
   component need not meet. Those outside a group's largest component, few where pivots join a family, meet all nodes
   of the group in a second round of tiles, whose links join the first ones before components are made anew.

With k = 40 and matches = 18, a pair at the least similarity 0.8 is passed over with a probability under 1e-6; links
that are found are exact.

Defined results: null and empty texts, and texts without a word, have the empty set and are linked with nothing; a text
with fewer words than a shingle is one shingle; rows that repeat an id are rows of their own, linked by their texts; a
null id is never the least unless all in its component are null; an empty table gives no rows; extra columns do not
matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.common import Memo, drop_stored, fresh, map_slices, return_memory, stored

MEMO_WORDS = 120_000
#: Marks by hash which texts are asked for: so many a text, and no more in all; passing more texts only costs time.
BITS_EACH, MOST_BITS = 32, 1 << 24
#: Marks of texts to drop that are broadcast at most, some 16 MB.
MARKS = 1 << 20
#: Texts that a task remembers so as not to make their sets again.
MOST_DONE = 1 << 20
#: Nodes of a group that all its tiles have.
PIVOTS = 3
#: Over so many parts a hot key is dealt in joins.
SALTS = 8


@dataclass(frozen=True)
class Params:
    words: int = 5
    percent: int = 80
    k: int = 40
    matches: int = 18
    seed: int = 1
    tile_nodes: int = 512
    tile_shingles: int = 1 << 19

    @property
    def prefix(self) -> int:
        return self.k - self.matches + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sets of shingle fingerprints, and to signatures."""

    def __init__(self, params: Params):
        rng = np.random.default_rng(params.seed)
        self.params = params
        self.memo = Memo(xxhash.xxh64_intdigest, MEMO_WORDS)
        self.turns = rng.integers(1, 2**63, params.words + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.factors = rng.integers(1, 2**63, params.k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 2**63, params.k, dtype=np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingles: A-Z in lower case, words between ASCII white space."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        n = min(self.params.words, len(words))
        count = len(words) - n + 1
        total = np.full(count, n, np.uint64) * self.turns[-1]
        for i in range(n):
            total = _mixed(total + hashes[i : i + count]) * self.turns[i]
        return np.unique(_mixed(total))

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of k minima, cut to 32 bits, for each set, none of which is empty."""
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets)])[:-1]
        out = np.empty((len(sets), self.params.k), np.uint32)
        for j, (factor, shift) in enumerate(zip(self.factors, self.shifts, strict=True)):
            out[:, j] = np.minimum.reduceat(flat * factor + shift, starts) >> np.uint64(32)
        return out


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def prints(docs: DataFrame, params: Params, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (null if the set is empty), signature of each row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("signature", pa.list_(pa.int32()))])

    def make():
        of = Shingler(params)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [of.shingles(x) for x in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            signed = iter(of.signatures(full).view(np.int32)) if full else iter(())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(schema.field(0).type),
                    batch.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(signed) if len(s) else None for s in sets], pa.list_(pa.int32())),
                ],
                schema=schema,
            )

        return kernel

    return map_slices(source, schema, f"doc_id {kind.simpleString()}, text_key long, n_shingles long, set_key binary, signature array<int>", make)


def nodes_of(printed: DataFrame) -> DataFrame:
    """A row a distinct set, numbered: node, set_key, signature, n_shingles, one of its texts, least id, copies."""
    made = printed.where("set_key IS NOT NULL").groupBy("set_key", "signature", "n_shingles").agg(F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.count("*").alias("n"))
    return stored(made.withColumn("node", F.monotonically_increasing_id()), "nodes")  # numbers hold once they are written


def groups(nodes: DataFrame, params: Params) -> DataFrame:
    """head, node: the nodes of all prefix posting lists that have the same least node (distinct)."""
    posted = nodes.select("node", F.posexplode("signature").alias("at", "value")).select("node", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long")).alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    # A pair that no other node has comes first in any order by rarity, so only the shared ones need be told apart.
    ranked = merged(posted, shared, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("tokens"))  # at most k a node
    kept = F.slice("tokens", F.lit(1), F.greatest(F.lit(0), F.lit(params.prefix - params.k) + F.size("tokens")))
    prefix = ranked.select("node", F.explode(kept).alias("t")).select("node", "t.token")
    # Sizes of linked sets are at most one step apart; each node is posted at its step and the next.
    step = F.floor(F.log("n_shingles") / float(np.log(100 / params.percent) * (1 + 1e-9))).cast("int")
    sized = nodes.select("node", F.explode(F.array(step, step + 1)).alias("step"))
    posts = stored(merged(prefix, sized, "node").select("node", "token", "step"), "posts")
    heads = posts.groupBy("token", "step").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").select("token", "step", "head")
    return merged(posts, heads, ["token", "step"]).select("head", "node").distinct()


def merged(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A join of which no side goes through the driver.

    Spark takes a side to be as large as the files it comes from. Exploded rows and packed columns are up to a hundred
    times that, so what it would broadcast can exceed the driver's memory, whatever the threshold.
    """
    return left.join(right.hint("merge"), on, how)


def salted(left: DataFrame, right: DataFrame, key: str, spread: str | Column, how: str = "inner") -> DataFrame:
    """left joined to right on key, unique in right, with the rows of a key in left dealt by another column."""
    dealt = left.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return merged(dealt, copies, [key, "salt"], how).drop("salt")


def placed_of(members: DataFrame, nodes: DataFrame, params: Params) -> DataFrame:
    """head, node, blocks, own, is_pivot: each node's block of its group, which has as many as its weight asks for."""
    known = merged(members, nodes.select("node", "n_shingles"), "node")
    pivots = F.array(*(F.min(F.struct(F.xxhash64("node", F.lit(i)), "node"))["node"] for i in range(PIVOTS)))
    weights = known.groupBy("head").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"), pivots.alias("pivots"))
    blocks = F.greatest(F.ceil(F.col("n") / params.tile_nodes), F.ceil(F.col("w") / params.tile_shingles)).cast("int")
    large = weights.select("head", blocks.alias("large"), "pivots").where("large > 1")  # few, by their size
    return (
        salted(known, large, "head", "node", "left")
        .withColumn("blocks", F.coalesce("large", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("is_pivot", F.coalesce(F.array_contains("pivots", F.col("node")), F.lit(False)))
        .select("head", "node", "blocks", "own", "is_pivot")
    )


def first_tiles(placed: DataFrame) -> DataFrame:
    """head, tile, block, two, node: each block of a group with the group's pivots."""
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    at = F.explode(F.when(F.col("is_pivot"), everywhere).otherwise(F.array("own")))
    return placed.select("head", at.alias("tile"), F.lit(0).alias("block"), F.lit(False).alias("two"), "node")


def second_tiles(placed: DataFrame, linked: DataFrame, params: Params) -> DataFrame | None:
    """Tiles in which the nodes outside their group's largest component (block 0) meet all of the group; None if there are none."""
    large = merged(placed.where("blocks > 1"), linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = large.groupBy("head", "component").agg(F.count("*").alias("n"))
    most = sizes.groupBy("head").agg(F.max(F.struct("n", "component"))["component"].alias("most"), F.count("*").alias("several"), (F.sum("n") - F.max("n")).alias("n_rest"))
    most = most.where("several > 1").withColumn("rest_blocks", F.ceil(F.col("n_rest") / params.tile_nodes).cast("int")).select("head", "most", "rest_blocks")
    most = stored(most, "most")
    if most.isEmpty():
        return None
    met = salted(large, most, "head", "node")
    own_rest = F.pmod(F.xxhash64("node", F.lit(7)), F.col("rest_blocks")).cast("int")
    columns = ("head", "tile", "block", "two", "node")
    rest = met.where("component <> most").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("tile", own_rest * F.col("blocks") + F.col("other")).withColumn("block", F.lit(0))
    all_ = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1))).withColumn("tile", F.col("other") * F.col("blocks") + F.col("own")).withColumn("block", F.lit(1))
    return rest.withColumn("two", F.lit(True)).select(*columns).unionByName(all_.withColumn("two", F.lit(True)).select(*columns))


def _tilewise(rows: DataFrame, names: list[str], ddl: str, schema: pa.Schema, make) -> DataFrame:
    """Runs make()(columns) on the rows of one tile at a time: a dictionary of Arrow arrays in, lists of columns out."""
    dealt = rows.select("head", "tile", *names).repartition("head", "tile").sortWithinPartitions("head", "tile")

    def run(batches):
        work, rest = make(), None

        def done(table: pa.Table) -> pa.RecordBatch | None:
            out = work(table)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema) if out and len(out[0]) else None

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            starts = _starts(table)
            # The last tile may go on in the next batch.
            if len(starts) > 1 and (out := done(table.slice(0, starts[-1]))) is not None:
                yield out
            rest = table.slice(starts[-1])
        if rest is not None and rest.num_rows and (out := done(rest)) is not None:
            yield out
        rest = table = None
        return_memory()

    return dealt.mapInArrow(run, ddl)


def _starts(table: pa.Table) -> np.ndarray:
    """Where tiles begin in rows that are sorted by tile."""
    head, tile = (table.column(c).to_numpy() for c in ("head", "tile"))
    new = np.ones(table.num_rows, bool)
    new[1:] = (tile[1:] != tile[:-1]) | (head[1:] != head[:-1])
    return np.flatnonzero(new)


def _matrix(column: pa.ChunkedArray, k: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(-1, k)


def partners(signatures: np.ndarray, block: np.ndarray, two: bool, least: int, nodes: np.ndarray) -> np.ndarray:
    """How many partners each row of a tile has with at least so many equal coordinates; of the other block, if there are two."""
    n, k = signatures.shape
    counts = np.zeros(n, np.int64)
    if two:
        left, right = np.flatnonzero(block == 0), np.flatnonzero(block == 1)
    else:
        left = right = np.arange(n)
    if not len(left) or not len(right):
        return counts
    other = signatures[right]
    step = max(1, (1 << 22) // (len(right) * k))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        hit = (signatures[rows][:, None, :] == other[None, :, :]).sum(2, dtype=np.int16) >= least
        hit &= nodes[rows][:, None] != nodes[right][None, :]
        counts[rows] += hit.sum(1)
        if two:
            counts[right] += hit.sum(0)
    return counts


def candidates(tiled: DataFrame, params: Params) -> DataFrame:
    """head, tile, block, two, node, n_partners: the rows of tiles that collide often enough with another."""
    schema = pa.schema([("head", pa.int64()), ("tile", pa.int32()), ("block", pa.int32()), ("two", pa.bool_()), ("node", pa.int64()), ("n_partners", pa.int64())])

    def make():
        def work(table: pa.Table):
            signed, block, two, names = _matrix(table.column("signature"), params.k), table.column("block").to_numpy(), table.column("two").to_numpy(zero_copy_only=False), table.column("node").to_numpy()
            starts = np.append(_starts(table), table.num_rows)
            counts, sizes = np.zeros(table.num_rows, np.int64), np.diff(starts)
            twos = starts[:-1][sizes == 2]  # most groups are two rows: all at once
            hit = ((signed[twos] == signed[twos + 1]).sum(1) >= params.matches) & (names[twos] != names[twos + 1]) & (~two[twos] | (block[twos] != block[twos + 1]))
            counts[twos[hit]] = counts[twos[hit] + 1] = 1
            for a, b in zip(starts[:-1][sizes > 2], starts[1:][sizes > 2], strict=True):
                counts[a:b] = partners(signed[a:b], block[a:b], bool(two[a]), params.matches, names[a:b])
            kept = table.filter(pa.array(counts > 0))
            return [*(kept.column(n).combine_chunks() for n in ("head", "tile", "block", "two", "node")), counts[counts > 0]]

        return work

    return _tilewise(tiled, ["block", "two", "node", "signature"], "head long, tile int, block int, two boolean, node long, n_partners long", schema, make)


def full_sets(docs: DataFrame, wanted: DataFrame, params: Params, text_col: str) -> DataFrame:
    """text_key, set_key, shingles (64-bit numbers) of the wanted nodes (node, text_key, set_key), from a second look at the texts.

    A bit map of bounded size tells most other texts apart before their sets are made or anything is shuffled. Where more
    texts are wanted than it can tell apart, texts are joined to the wanted ones' keys before any set is made.
    """
    many = wanted.count()
    source = docs.select(F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    if many * BITS_EACH > MOST_BITS:
        source = salted(source, wanted.select("text_key").distinct(), "text_key", F.spark_partition_id(), "left_semi")
    n_bits = min(MOST_BITS, max(1 << 10, 1 << (BITS_EACH * many).bit_length()))
    bit = F.pmod("text_key", F.lit(n_bits))
    marks = wanted.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.expr(f"bit_or(shiftleft(1L, CAST(pmod(text_key, {n_bits}) % 64 AS int)))").alias("bits")).toArrow()  # a 64th of the marks
    words = np.zeros(n_bits // 64, np.int64)
    words[marks.column("at").to_numpy()] = marks.column("bits").to_numpy()
    shipped = docs.sparkSession.sparkContext.broadcast(words)
    schema = pa.schema([("text_key", pa.int64()), ("set_key", pa.binary()), ("shingles", pa.binary())])

    def make():
        of, known, done = Shingler(params), np.unpackbits(shipped.value.astype("<i8").view(np.uint8), bitorder="little") == 1, set()

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = batch.column("text_key").to_numpy()
            rows = [i for i in np.flatnonzero(known[keys % n_bits]) if keys[i] not in done]  # a task needs a text once
            if len(done) < MOST_DONE:
                done.update(keys[rows].tolist())
            some = batch.take(pa.array(rows, pa.int64()))
            sets = [of.shingles(x) for x in some.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([some.column("text_key"), pa.array(map(set_key, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

        return kernel

    made = map_slices(source, schema, "text_key long, set_key binary, shingles binary", make)
    return made.groupBy("text_key", "set_key").agg(F.first("shingles").alias("shingles"))  # of copies of a text, all have the same


def confirm(sets: list[np.ndarray], n_partners: np.ndarray, block: np.ndarray, two: bool, percent: int) -> list[int]:
    """The component of each row of a tile, as the least row in it, by links of at least so many percent.

    With two blocks, only pairs across them need be met here; what else is found is as true.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, code = np.unique(flat, return_inverse=True)
    order = np.argsort(code, kind="stable")
    lists = np.concatenate([[0], np.cumsum(np.bincount(code))])
    holders, ends = owner[order], np.cumsum(sizes)
    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def meet(x: int) -> None:
        own = code[ends[x] - sizes[x] : ends[x]]
        start, size = lists[own], lists[own + 1] - lists[own]
        at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        shared = np.bincount(holders[at], minlength=n)
        for y in np.flatnonzero(100 * shared >= percent * (sizes + sizes[x] - shared)):
            a, b = root(x), root(int(y))
            parent[max(a, b)] = min(a, b)

    meet(int(np.argmax(n_partners)))
    largest = np.bincount([root(x) for x in range(n)]).argmax()
    for x in range(n):
        if root(x) != root(int(largest)):
            meet(x)
    return [root(x) for x in range(n)]


def links(found: DataFrame, nodes: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """a, b: stars of linked nodes, one for each component of a tile. sets are read by text_key and set_key, and go to the tiles at once."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def make():
        def work(table: pa.Table):
            names = table.column("node").to_numpy()
            raw = table.column("shingles").to_pylist()
            n_partners, block, two = (table.column(c).to_numpy() for c in ("n_partners", "block", "two"))
            starts = np.append(_starts(table), table.num_rows)
            a, b = [], []
            for i, j in zip(starts[:-1], starts[1:], strict=True):
                rows = confirm([np.frombuffer(x, np.uint64) for x in raw[i:j]], n_partners[i:j], block[i:j], bool(two[i]), params.percent)
                for x, top in enumerate(rows):
                    if x != top:
                        a.append(names[i + top])
                        b.append(names[i + x])
            return [a, b]

        return work

    rows = merged(merged(found, nodes.select("node", "text_key", "set_key"), "node"), sets, ["text_key", "set_key"])
    return _tilewise(rows, ["block", "two", "node", "n_partners", "shingles"], "a long, b long", schema, make)


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node): of every node that an edge (a, b) names. Alternating stars, each round stored."""

    def either(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def large(e: DataFrame) -> DataFrame:
        near = either(e)
        least = near.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top")).where("top > u").select("u", F.least("u", "m").alias("m"))  # the tips of stars have none to hand on
        return salted(near.where("v > u"), least, "u", "v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top"))
        other = salted(down, least.where("top <> m").select("u", "m"), "u", "v").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
        return other.unionAll(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())

    now = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = digest(now)
    while seen[0]:
        then = stored(small(large(now)), "edges")
        found = digest(then)
        drop_stored(now)
        now = then
        if found == seen:
            break
        seen = found
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def find(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, component_id (the least id it reaches by links) and kept of each row."""
    printed = stored(prints(docs, params, id_col, text_col), "prints")
    nodes = nodes_of(printed)
    placed = stored(placed_of(stored(groups(nodes, params), "groups"), nodes, params), "placed")

    def edges(tiled: DataFrame) -> DataFrame:
        found = stored(candidates(merged(tiled, nodes.select("node", "signature"), "node"), params), "candidates")
        wanted = stored(merged(found.select("node").distinct(), nodes.select("node", "text_key", "set_key"), "node"), "wanted")
        return links(found, nodes, full_sets(docs, wanted, params, text_col), params)

    first = stored(edges(first_tiles(placed)), "links")
    linked = components(first)
    if (more := second_tiles(placed, linked, params)) is not None:
        linked = components(first.unionByName(stored(edges(more), "links")))
    # The least id of each component; alone are the nodes that no link names.
    of = merged(nodes.select("node", "set_key", "least", "n"), linked, "node", "left").withColumn("alone", F.col("component").isNull()).withColumn("component", F.coalesce("component", "node"))
    joint = of.where("NOT alone").groupBy("component").agg(F.min("least").alias("component_id"))
    told = salted(of, joint, "component", "node", "left").where("n > 1 OR NOT alone").select("set_key", F.when(F.col("alone"), F.col("least")).otherwise(F.col("component_id")).alias("told"), F.lit(True).alias("is_told"))
    # Copies of one text, and texts without a word, are dealt by where they were written.
    out = salted(printed, told, "set_key", F.spark_partition_id() + F.xxhash64("doc_id"), "left")
    component = F.when(F.col("is_told"), F.col("told")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the least id, with all its columns.

    Rows that repeat an id that stays become one, of those with equal texts any. Rows without an id stay where no row
    of their component has one.
    """
    judged = stored(find(docs, params, id_col, text_col).select("doc_id", "text_key", "component_id", "kept"), "judged")
    gone = judged.where("NOT kept").select("doc_id", "text_key")
    several = judged.where("kept AND doc_id IS NOT NULL").groupBy("component_id").agg(F.count("*").alias("n"), F.min("text_key").alias("first")).where("n > 1")
    other = merged(judged.where("kept"), several, "component_id").where("text_key <> first").select("doc_id", "text_key")
    drop_id, drop_key, again = (fresh(docs, n) for n in ("drop_id", "drop_key", "again"))
    drop = gone.unionAll(other).distinct().select(F.col("doc_id").alias(drop_id), F.col("text_key").alias(drop_key))
    drop = stored(drop, "drop")
    one_id, key = F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))
    # At most MARKS marks tell most texts that stay apart; only the others are shuffled to be compared in full.
    marks = F.broadcast(drop.select(F.pmod(drop_key, F.lit(MARKS)).alias(again)).distinct())
    marked = F.pmod(key, F.lit(MARKS)) == F.col(again)
    doubtful = merged(docs.join(marks, marked, "left_semi"), drop, one_id.eqNullSafe(F.col(drop_id)) & (key == F.col(drop_key)), "left_anti")
    left = docs.join(marks, marked, "left_anti").unionByName(doubtful)
    if several.isEmpty():
        return left
    repeated = several.select(F.col("component_id").alias(again))
    match = one_id == F.col(again)
    return left.join(repeated, match, "left_anti").unionByName(left.join(repeated, match, "left_semi").dropDuplicates([id_col]))
