"""Prefix trie of conversations: every distinct beginning of a conversation, with what its subtree holds.

* Turns are numbered in their order over range parts (``ordinals``), so a conversation of any length needs no task of its
  own. ``rebuilt`` derives conversations that share beginnings; the operator itself takes any turns.
* A turn is 16 bytes of the SHA-256 of role and text; texts are left behind. Conversations with the same turns are one
  path with a weight: a combination of their turns' hashes that is aggregated before the shuffle tells them apart.
* Paths are dealt by a hash of their first turn's digest; each bucket is a pandas group in which the tries of its first
  turns are built with dictionaries of children, and summed by an iterative postorder.
* A first turn whose paths have more than ``most_turns`` turns is dealt by its next turn, and so on while that holds and
  more than one path is left; the nodes above such a cut are summed from their children by a join. One path alone
  is a chain and is summed by a window. So the size of a group is bounded, however many conversations begin alike.
* The digest of the ids that end at a node is streamed over ids in order, some 4,096 of them to a row: SHA-256 takes its
  input in sequence, so the ids (not the turns) that end at one node pass through one task, in constant memory.

Defined results: a null role or text is empty; turns go by number, null ones first, then by digest, so repeated rows are
turns of their own; rows without a conversation's id take no part; a conversation without turns ends at the root; the root
is there if any conversation is; texts of any length count whole; extra columns are ignored, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.llm.common import stored
from quern.operators import ordinals

DIGEST_BYTES = 16
#: Ids that share these low bits' complement are hashed as one row.
ID_BITS = 12
NODE = "key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = b""


@dataclass(frozen=True)
class Params:
    """most_turns: of the paths that are built in one group; bucket_turns: of a bucket, about; salts: parts of a hot key."""

    most_turns: int = 50_000
    bucket_turns: int = 50_000
    salts: int = 16


def salted(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int, how: str = "inner") -> DataFrame:
    """left joined to right, whose key is unique; a key's rows of left are dealt by another column."""
    dealt = left.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    copies = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copies.hint("merge"), [key, "salt"], how).drop("salt")  # Spark judges copies by one of them, and would broadcast all


def shortened(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, DIGEST_BYTES)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 1, in the conversation's order), digest and n_chars of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = shortened(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("n_chars"))
    return ordinals.ordered(rows, "conv_id", "turn", "digest", name="place").drop("turn")


def numbered(placed: DataFrame, salts: int) -> DataFrame:
    """conv_id, at, digest, n_chars of rows in their places."""
    firsts = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return salted(placed, firsts, "conv_id", "place", salts).select("conv_id", (F.col("place") - F.col("first") + 1).alias("at"), "digest", "n_chars")


def rebuilt(turns: DataFrame, params: Params = Params(), block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """All conversations, and the turns (conv_id, at, digest, n_chars) of each when its beginning is that of its block's head.

    The first h turns come from conversation c - c % block, as many as it has; c's own first h turns go. h is the CRC-32
    of c modulo ``most``.
    """
    own = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most))
    base = F.col("conv_id") - F.col("conv_id") % block
    counts = turns.groupBy("conv_id").agg(F.max("at").alias("n"))
    convs = counts.select("conv_id", own.alias("h"), base.alias("base"))
    heads = counts.select(F.col("conv_id").alias("base"), F.least("n", F.lit(most - 1)).alias("base_n"))
    convs = stored(convs.join(heads, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))).alias("taken")), "conversations")
    first = turns.where((F.col("at") < most) & (F.col("conv_id") % block == 0)).select(F.col("conv_id").alias("base"), "at", "digest", "n_chars")
    begin = convs.join(first, "base").where(F.col("at") <= F.col("taken")).select("conv_id", "at", "digest", "n_chars")  # a block has at most 199 conversations
    rest = salted(turns.where(F.col("at") > own), convs.select("conv_id", "h", "taken"), "conv_id", "at", params.salts)
    return convs.select("conv_id"), begin.unionByName(rest.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "digest", "n_chars"))


def ends_of(members: DataFrame) -> DataFrame:
    """path and ends: the SHA-256 of its conversations' decimal ids in order, joined by commas."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = members.groupBy("path", F.shiftright("conv_id", ID_BITS).alias("chunk")).agg(ids.alias("ids"))  # at most 4,096 ids

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, state = None, None
        for frame in frames:
            done = []
            for p, ids in zip(frame["path"], frame["ids"], strict=True):
                if p != path:
                    if state is not None:
                        done.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=["path", "ends"])
        if state is not None:
            yield pd.DataFrame([(path, state.hexdigest())], columns=["path", "ends"])

    return chunks.repartition("path").sortWithinPartitions("path", "chunk").select("path", "ids").mapInPandas(run, "path string, ends string")


def paths_of(convs: DataFrame, turns: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """paths: rep (the smallest conversation), w (how many), length, ends. steps: the turns of each path's rep, with its w,
    length and, at its last turn, ends."""
    lanes = [F.bit_xor(F.xxhash64("digest", "at", F.lit(i))).alias(f"lane_{i}") for i in range(3)]
    sums = turns.groupBy("conv_id").agg(*lanes, F.count("*").alias("length"))
    path = F.coalesce(F.concat_ws(":", "length", *(f"lane_{i}" for i in range(3))), F.lit(""))
    members = stored(convs.join(sums, "conv_id", "left").select("conv_id", F.when(F.col("length").isNull(), "").otherwise(path).alias("path"), F.coalesce("length", F.lit(0).cast("long")).alias("length")), "members")
    totals = members.groupBy("path", "length").agg(F.min("conv_id").alias("rep"), F.count("*").alias("w"))
    paths = stored(totals.join(ends_of(members).hint("merge"), "path").select("rep", "w", "length", "ends"), "paths")
    own = salted(turns.withColumnRenamed("conv_id", "rep"), paths, "rep", "at", params.salts)
    steps = own.withColumn("ends", F.when(F.col("at") == F.col("length"), F.col("ends")))
    return paths, stored(steps, "steps")


def assigned(steps: DataFrame, params: Params) -> tuple[DataFrame, list[DataFrame]]:
    """Where each path is built: rep, key, parent, depth, alone (one path of too many turns). And, for each depth from 1 on, the
    steps of paths whose first turns were cut there: key, parent, rep, w, length, n_chars, ends."""
    row = ["rep", "w", "length", "n_chars", "ends"]
    open_ = steps.where("at = 1").select(F.col("digest").alias("key"), F.lit(ROOT).alias("parent"), *row)
    done, cuts, depth = [], [], 1
    while True:
        open_ = stored(open_, "open")
        sizes = open_.groupBy("key").agg(F.sum(F.col("length") - depth + 1).alias("turns"), F.count("*").alias("n"))
        large = stored(sizes.where(F.col("turns") > params.most_turns).select("key", (F.col("n") == 1).alias("one")), "large")
        found = salted(open_, large, "key", "rep", params.salts, "left")
        done.append(found.where("one IS NULL OR one").select("rep", "key", "parent", F.lit(depth).alias("depth"), F.coalesce("one", F.lit(False)).alias("alone")))
        if large.where(~F.col("one")).isEmpty():
            break
        cut = stored(found.where(~F.col("one")).drop("one"), "cut")
        cuts.append(cut)
        nexts = steps.where(F.col("at") == depth + 1).select("digest", *row)
        after = nexts.join(cut.select("rep", F.col("key").alias("parent")).hint("merge"), "rep")  # a row each side
        open_ = after.select(shortened(F.concat("parent", "digest")).alias("key"), "parent", *row)
        depth += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, cuts


def build(frame: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a bucket's tries: tops are the nodes that stand at the depth where their paths were dealt."""
    keys, names = pd.factorize(frame["key"])
    reps, ats = frame["rep"].to_numpy(), frame["at"].to_numpy()
    children: list[dict[bytes, int]] = []
    above, depth, conv, count, chars, ends, key_of = [], [], [], [], [], [], []
    tops: dict[int, int] = {}

    def node(parent: int, i: int) -> int:
        children.append({})
        for column, value in ((above, parent), (depth, int(ats[i])), (conv, int(reps[i])), (count, 0), (chars, int(n_chars[i])), (ends, None), (key_of, int(keys[i]))):
            column.append(value)
        return len(children) - 1

    n_chars, weights, digests, ended = frame["n_chars"].to_numpy(), frame["w"].to_numpy(), frame["digest"].to_numpy(), frame["ends"].to_numpy()
    here, last = -1, None
    for i in np.lexsort((ats, reps, keys)):
        path = (keys[i], reps[i])
        if path != last:  # paths come by their smallest conversation, so whoever makes a node gives it its number
            last, k = path, int(keys[i])
            if k not in tops:
                tops[k] = node(-1, i)
            here = tops[k]
        else:
            found = children[here].get(digests[i])
            if found is None:
                found = children[here][digests[i]] = node(here, i)
            here = found
        count[here] += int(weights[i])
        if ended[i] is not None:
            ends[here] = ended[i]
    leaves, saved = [0] * len(children), [0] * len(children)
    for top in tops.values():
        waiting, order = [top], []
        while waiting:
            at = waiting.pop()
            order.append(at)
            waiting.extend(children[at].values())
        for at in reversed(order):  # children before parents
            leaves[at] = sum(leaves[c] for c in children[at].values()) or 1
            saved[at] = (count[at] - 1) * chars[at] + sum(saved[c] for c in children[at].values())
    parent_of = dict(zip(keys, frame["parent"], strict=True))
    is_top = [a < 0 for a in above]
    return pd.DataFrame(
        {
            "key": [names[k] if top else None for k, top in zip(key_of, is_top, strict=True)],
            "parent": [parent_of[k] if top else None for k, top in zip(key_of, is_top, strict=True)],
            "conv_id": conv,
            "depth": depth,
            "parent_conv_id": pd.array([None if a < 0 else conv[a] for a in above], dtype="Int64"),
            "n_convs": count,
            "n_children": [len(c) for c in children],
            "n_leaves": leaves,
            "saved_tokens": saved,
            "ends": ends,
        }
    )


def chains(rows: DataFrame) -> DataFrame:
    """The nodes of paths that stand alone: what follows a turn is summed by a window, which spills."""
    below = Window.partitionBy("rep").orderBy(F.col("at").desc())
    top, last = F.col("at") == F.col("depth"), F.col("at") == F.col("length")
    return rows.select(
        F.when(top, F.col("key")).alias("key"),
        F.when(top, F.col("parent")).alias("parent"),
        F.col("rep").alias("conv_id"),
        F.col("at").alias("depth"),
        F.when(~top, F.col("rep")).alias("parent_conv_id"),
        F.col("w").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.sum((F.col("w") - 1) * F.col("n_chars")).over(below).alias("saved_tokens"),
        "ends",
    )


def above(tops: DataFrame, nodes: DataFrame, ended: DataFrame, depth: int) -> DataFrame:
    """The nodes (key, parent, n_chars) of a depth, summed from those below (tops, by their parent) and from the paths that end there."""
    sums = tops.groupBy(F.col("parent").alias("key")).agg(
        F.min("conv_id").alias("below"), F.sum("n_convs").alias("n"), F.count("*").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    own = ended.select("key", F.col("rep").alias("own"), "w", F.col("ends").alias("own_ends"))  # one path a node at most
    joined = nodes.join(sums.hint("merge"), "key", "left").join(own.hint("merge"), "key", "left")
    zero = F.lit(0).cast("long")
    count = F.coalesce("n", zero) + F.coalesce("w", zero)
    return joined.select(
        "key",
        "parent",
        F.least("below", "own").alias("conv_id"),
        F.lit(depth).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        count.alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        ((count - 1) * F.col("n_chars") + F.coalesce("saved", zero)).alias("saved_tokens"),
        F.col("own_ends").alias("ends"),
    )


def trie(convs: DataFrame, turns: DataFrame, params: Params = Params()) -> DataFrame:
    """The nodes of all conversations (conv_id) with their turns (conv_id, at, digest, n_chars)."""
    paths, steps = paths_of(convs, turns, params)
    where, cuts = assigned(steps, params)
    total = paths.agg(F.sum("length").alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // params.bucket_turns))
    where = stored(where, "where")
    many = salted(steps, where, "rep", "at", params.salts).where(F.col("at") >= F.col("depth"))
    grouped = many.where(~F.col("alone")).select("key", "parent", "rep", "at", "w", "digest", "n_chars", "ends").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    built = grouped.groupBy("bucket").applyInPandas(lambda frame: build(frame), NODE)
    nodes = stored(built.unionByName(chains(many.where("alone"))), "nodes")
    # From the deepest cut up to the root.
    levels, tops = [], nodes.where("parent IS NOT NULL")
    for depth in range(len(cuts), 0, -1):
        cut = cuts[depth - 1]
        here = cut.groupBy("key", "parent").agg(F.first("n_chars").alias("n_chars"))
        level = stored(above(tops.where(F.col("depth") == depth + 1), here, cut.where(F.col("length") == depth), depth), "level")
        levels.append(level)
        tops = tops.unionByName(level)
    none = F.lit(ROOT)
    root = paths.limit(1).select(none.alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("n_chars"))
    levels.append(stored(above(tops.where(F.col("depth") == 1), root, paths.where("length = 0").withColumn("key", none), 0), "root"))
    inner, uppers = nodes.where("parent IS NULL"), levels[0]
    for level in levels[1:]:
        uppers = uppers.unionByName(level)
    numbers = uppers.select(F.col("key").alias("parent"), F.col("conv_id").alias("number"))
    tops = nodes.where("parent IS NOT NULL").unionByName(uppers)
    linked = salted(tops, numbers, "parent", "key", params.salts, "left").withColumn("parent_conv_id", F.col("number")).drop("number")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return inner.unionByName(linked).select(*columns, F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, params: Params = Params()) -> DataFrame:
    """The trie of all rebuilt conversations."""
    turns = stored(numbered(turns_of(conversations), params.salts), "turns")
    return trie(*rebuilt(turns, params), params)
