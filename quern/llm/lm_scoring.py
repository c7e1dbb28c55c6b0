"""Language-model scores by stupid backoff, computed relationally over n-gram count tables partitioned by hash.

An n-gram of ``order`` words scores count(n-gram) / count(its context), or, where the corpus has none, ``backoff`` times
the score of the n-gram one word shorter; a single word scores count(word) / words. With ``leave_out`` all counts of the
document itself are taken off first, so every document is scored by the others and rare n-grams do back off. Words are
lower-cased runs without ASCII white space; the first of a document follows a start mark.

1. Explode: a task cuts its documents into blocks and counts the n-grams of each block, so a frequent n-gram is one
   entry a block and no hot key. Entries, sorted by a 64-bit hash, go to the partitions of the count table by the
   leading bits of the hash.
2. Join: a partition of the count table adds up each n-gram's entries and gives every entry the count of the other
   blocks, in the order in which the block sent them.
3. Sum: a block's answers and its texts meet again; each word of a document is scored and the logs are summed.

Entries travel packed: sorted hashes as differences, counts as bytes, both compressed, so an entry takes some six bytes,
and texts go along compressed. Nothing comes to the driver but the number of the texts' bytes, which sets the number of
partitions; memory is bounded by a block (``block_bytes``, or one text) and by a partition of the table.

Defined results: documents with no word (null, empty or blank texts) have 0 words and a null score; repeated ids are
rows of their own, scored by each other; equal texts have equal scores; a word that only the document has counts as
seen once; texts of any length are scored whole, a longer one than a block as a block; extra columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.common import return_memory

#: No word, as it holds a blank.
START = b" start"
#: Bytes of text whose n-grams a partition of the count table holds, about.
TABLE_BYTES = 1 << 25
#: Words that are scored at once.
STEP_WORDS = 1 << 18


@dataclass(frozen=True)
class Params:
    order: int = 2
    backoff: float = 0.4
    leave_out: bool = True
    block_bytes: int = 1 << 24


def _mixed(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two."""
    x = u * np.uint64(0x9E3779B97F4A7C15) + v
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x ^= x >> np.uint64(31)
        x *= np.uint64(by)
    return x ^ (x >> np.uint64(31))


def packed(x: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8).T
    used = max((i + 1 for i in range(8) if planes[i].any()), default=0)
    return struct.pack("<QB", len(x), used) + pa.Codec("zstd", 1).compress(planes[:used].tobytes(), asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    n, used = struct.unpack_from("<QB", raw)
    out = np.zeros((n, 8), np.uint8)
    if n and used:
        out[:, :used] = np.frombuffer(pa.Codec("zstd", 1).decompress(raw[9:], n * used, asbytes=True), np.uint8).reshape(used, n).T
    return out.view("<u8").reshape(-1)


class Level:
    """The distinct n-grams of one length in a block: hashes, counts, and how often a word follows them."""

    def __init__(self, hashes: np.ndarray, ids: np.ndarray, followed: np.ndarray):
        self.hashes, self.ids = hashes, ids  # ids: by place in the block, -1 where no n-gram of this length ends
        here = ids >= 0
        self.count = np.bincount(ids[here], minlength=len(hashes))
        self.context = np.bincount(ids[here & followed], minlength=len(hashes))
        self.order = np.argsort(hashes, kind="stable")


class Block:
    """Texts as places, a start mark before each text's words, and the n-grams that end at each place."""

    def __init__(self, texts: list[str | None], order: int):
        codes: defaultdict[bytes, int] = defaultdict()
        codes.default_factory = codes.__len__
        start = codes[START]
        found = []
        for text in texts:
            words = (text or "").lower().encode("utf-8", "surrogatepass").split()
            found.append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
        self.sizes = np.array([len(x) + 1 for x in found], np.int64)
        self.words = np.concatenate([y for x in found for y in (np.array([start]), x)]) if found else np.empty(0, np.int64)
        del found
        self.first = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(self.words)) - np.repeat(self.first, self.sizes)
        followed = np.ones(len(self.words), bool)
        followed[self.first + self.sizes - 1] = False
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, codes), np.uint64, len(codes))
        self.levels = [Level(hashes, self.words, followed)]
        # The start mark is never a word; the number of all words takes its place.
        self.levels[0].count[start] = len(self.words) - len(self.sizes)
        for n in range(2, order + 1):
            last = self.levels[-1]
            at = np.flatnonzero(place >= n - 1)
            grams, ids = np.unique(last.ids[at - 1] * len(hashes) + self.words[at], return_inverse=True)
            everywhere = np.full(len(self.words), -1, np.int64)
            everywhere[at] = ids
            self.levels.append(Level(_mixed(last.hashes[grams // len(hashes)], hashes[grams % len(hashes)]), everywhere, followed))

    def entries(self, bits: int) -> Iterator[tuple[int, list[bytes]]]:
        """For each partition of the count table that has some the entries of every level: hashes, counts, counts as context."""
        cuts = []
        for level in self.levels:
            sorted_ = level.hashes[level.order]
            cuts.append((sorted_, level.count[level.order], level.context[level.order], np.searchsorted(sorted_ >> np.uint64(64 - bits) if bits else np.zeros(len(sorted_), np.uint64), np.arange((1 << bits) + 1, dtype=np.uint64))))
        for i in range(1 << bits):
            out = []
            for hashes, count, context, at in cuts:
                part = hashes[at[i] : at[i + 1]]
                out += [packed(np.diff(part, prepend=np.uint64(0))), packed(count[at[i] : at[i + 1]]), packed(context[at[i] : at[i + 1]])]
            if any(at[i] < at[i + 1] for *_, at in cuts):  # most parts of a small block are empty
                yield i, out

    def score(self, others: list[tuple[np.ndarray, np.ndarray]], params: Params) -> tuple[np.ndarray, np.ndarray]:
        """The number of words and the score of each text, by the counts of other blocks in the order of entries."""
        totals = []
        for level, (count, context) in zip(self.levels, others, strict=True):
            if len(count) != len(level.hashes):
                raise ValueError("a block's texts are not those that its n-grams were counted in")
            both = np.append(level.count, 0), np.append(level.context, 0)  # the last is for places without an n-gram
            both[0][level.order] += count
            both[1][level.order] += context
            totals.append(both)
        words = int(totals[0][0][0])
        scores, ends = np.zeros(len(self.sizes)), np.cumsum(self.sizes)
        a = 0
        while a < len(self.sizes):
            b = max(a + 1, int(np.searchsorted(ends, self.first[a] + STEP_WORDS, "right")))
            scores[a:b] = self._scored(slice(self.first[a], ends[b - 1]), self.sizes[a:b], totals, words, params)
            a = b
        return self.sizes - 1, scores

    def _scored(self, places: slice, sizes: np.ndarray, totals, words: int, params: Params) -> np.ndarray:
        doc = np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(np.concatenate([[False], doc[1:] == doc[:-1]]))  # the places of words
        doc = doc[at]
        score, done, backed = np.zeros(len(at)), np.zeros(len(at), bool), np.zeros(len(at))
        for n in range(len(totals), 1, -1):
            grams = self.levels[n - 1].ids[places][at]
            contexts = self.levels[n - 2].ids[places][at - 1]
            able = (grams >= 0) & ~done
            seen, follow = totals[n - 1][0][grams], totals[n - 2][1][contexts]
            if params.leave_out:
                seen, follow = seen - _own(doc, grams), follow - _own(doc, contexts)
            hit = able & (seen > 0)
            score[hit] = np.log(seen[hit] / follow[hit])
            done |= hit
            backed += able & ~hit
        single = self.words[places][at]
        seen, left = totals[0][0][single], np.full(len(sizes), words)
        if params.leave_out:
            seen, left = seen - _own(doc, single), left - (sizes - 1)
        score[~done] = (np.log(np.maximum(seen, 1)) - np.log(np.maximum(left, 1))[doc])[~done]
        return np.bincount(doc, score + backed * math.log(params.backoff), len(sizes))


def _own(doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """How often each place's document has the place's id."""
    if not len(ids):
        return np.empty(0, np.int64)
    _, inverse, n = np.unique(doc * (int(ids.max()) + 2) + ids, return_inverse=True, return_counts=True)
    return n[inverse]


class Rows:
    """Rows on their way: to a partition of the count table or back to a block; texts (part -1) or packed numbers."""

    def __init__(self, kind_of_id, to_blocks: bool = False):
        self.ddl = f"to long, block long, part int, packed array<binary>, ids array<{kind_of_id.simpleString()}>"
        self.id_type = to_arrow_type(kind_of_id)
        self.to_blocks = to_blocks
        self.schema = pa.schema([("to", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("packed", pa.list_(pa.binary())), ("ids", pa.list_(self.id_type))])

    def row(self, to: int, block: int, part: int, blobs: list[bytes], ids: pa.Array | None = None) -> pa.RecordBatch:
        ids = pa.nulls(1, self.schema.field("ids").type) if ids is None else pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        values = [pa.array([x], t) for x, t in zip((to, block, part, blobs), self.schema.types, strict=False)]
        return pa.RecordBatch.from_arrays([*values, ids], schema=self.schema)

    def sent(self, rows: DataFrame, n: int) -> DataFrame:
        """Rows at the partition of their number: a count table's own, or one for each of a task's blocks in turn."""
        place = F.pmod(F.shiftright("to", 32) + F.lit(61) * F.col("to").bitwiseAND(F.lit((1 << 32) - 1)), F.lit(n)) if self.to_blocks else F.col("to")
        return rows.repartitionById(n, place.cast("int")).sortWithinPartitions("to", "block", "part")


def _exploded(docs: DataFrame, rows: Rows, bits: int, params: Params) -> DataFrame:
    def run(batches):
        task, n, texts, ids, size = TaskContext.get().partitionId(), 0, [], [], 0

        def closed():
            block = (task << 32) + n
            for part, blobs in Block(texts, params.order).entries(bits):
                yield rows.row(part, block, part, blobs)
            raw = [(x or "").encode("utf-8", "surrogatepass") for x in texts]
            joined = b"".join(raw)
            lengths = packed(np.array([len(x) for x in raw], np.int64))
            blob = struct.pack("<Q", len(joined)) + pa.Codec("zstd", 3).compress(joined, asbytes=True)
            # Texts only pass through the count table; a number of the block's own deals them evenly.
            yield rows.row((task + 61 * n) & ((1 << bits) - 1), block, -1, [lengths, blob], pa.concat_arrays(ids))

        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                if texts and size + len(text or "") > params.block_bytes:
                    yield from closed()
                    n, texts, ids, size = n + 1, [], [], 0
                texts.append(text)
                ids.append(batch.column("doc_id").slice(i, 1))
                size += len(text or "")
            ids = [pa.concat_arrays(ids)] if ids else []  # lets the batch go
        if texts:
            yield from closed()
        texts, ids = [], []
        return_memory()

    return docs.mapInArrow(run, rows.ddl)


def _by(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """The rows of each key, which come together; ids stay Arrow arrays."""
    held, last = [], None
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column("ids")[i]
            row = {c: batch.column(c)[i].as_py() for c in ("to", "block", "part", "packed")} | {"ids": ids.values if ids.is_valid else None}
            if held and row[key] != last:
                yield held
                held = []
            held.append(row)
            last = row[key]
    if held:
        yield held


def _joined(entries: DataFrame, rows: Rows) -> DataFrame:
    def run(batches):
        for group in _by(batches, "to"):
            asked = []
            for r in group:
                if r["part"] < 0:
                    yield rows.row(r["block"], r["block"], -1, r["packed"], r["ids"])
                else:
                    asked.append(r)
            answers: list[list[bytes]] = [[] for _ in asked]
            for at in range(0, len(asked[0]["packed"]) if asked else 0, 3):
                keys = [np.cumsum(unpacked(r["packed"][at])) for r in asked]
                ends = np.cumsum([len(x) for x in keys])
                _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
                del keys
                for which in (1, 2):
                    n = np.concatenate([unpacked(r["packed"][at + which]) for r in asked]).astype(np.int64)
                    left = np.split(np.bincount(inverse, n).astype(np.int64)[inverse] - n, ends[:-1])
                    for answer, x in zip(answers, left, strict=True):
                        answer.append(packed(x))
            for r, answer in zip(asked, answers, strict=True):
                yield rows.row(r["block"], r["block"], r["part"], answer)
        return_memory()

    return entries.mapInArrow(run, rows.ddl)


def score(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logs) and mean_log_score of each row."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TABLE_BYTES).bit_length()
    rows = Rows(docs.schema["doc_id"].dataType)
    out = pa.schema([("doc_id", rows.id_type), ("n_words", pa.int64()), ("log_score", pa.float64())])

    def run(batches):
        for group in _by(batches, "to"):
            (texts,) = (r for r in group if r["part"] < 0)
            lengths, raw = unpacked(texts["packed"][0]).astype(np.int64), texts["packed"][1]
            raw = pa.Codec("zstd", 3).decompress(raw[8:], struct.unpack_from("<Q", raw)[0], asbytes=True)
            ends = np.cumsum(lengths).tolist()
            block = Block([raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends, strict=False)], params.order)
            parts = [r["packed"] for r in group if r["part"] >= 0]
            others = [tuple(np.concatenate([unpacked(p[2 * n + which]) for p in parts]).astype(np.int64) for which in (0, 1)) for n in range(params.order)]
            n_words, scores = block.score(others, params)
            yield pa.RecordBatch.from_arrays([texts["ids"], pa.array(n_words), pa.array(scores, mask=n_words == 0)], schema=out)
            del block, others, raw
        return_memory()

    asked = rows.sent(_exploded(docs, rows, bits, params), 1 << bits)
    answered = Rows(docs.schema["doc_id"].dataType, to_blocks=True).sent(_joined(asked, rows), 1 << bits)
    found = answered.mapInArrow(run, f"doc_id {rows.ddl.rpartition('array<')[2][:-1]}, n_words long, log_score double")
    return found.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round(F.try_divide("log_score", "n_words"), 6).alias("mean_log_score"))
