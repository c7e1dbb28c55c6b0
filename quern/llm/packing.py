"""Best-fit packing of documents into token sequences by linear grouping.

Documents become pieces of at most ``capacity`` tokens, and all that packing needs to know of the pieces is how many
there are of each length. So the plan is made on the driver from a histogram of at most ``capacity`` rows, whatever the
input's size:

1. Large lengths are put, longest first, into groups of equal cardinality and rounded up to their group's longest.
2. The few rounded sizes are packed by configurations (which sizes share a sequence). The relaxed covering problem is
   solved by column generation and rounded down; what that leaves over goes to step 4.
3. Actual pieces take the configurations' places, longest first within a group, so every sequence gets a remainder of
   at least what was planned. From sequences that leave more than a bound the shortest piece is taken out again.
4. What is left over, and the small pieces, go longest first where they fit best, opening a sequence when none fits.

Rounding pays where small pieces can fill what it leaves. So two groupings and five bounds on what a sequence may leave are
planned, and the plan with the fewest sequences is taken, of equal ones that with most sequences from configurations.

Sequences that are filled alike are kept as one run, (first sequence, how many, remainder), and pieces of one length as
ranks, so the plan is a short table of placements. A piece finds its place from its length and its rank among the
pieces of that length alone. Ranks are counted over salted buckets of a length, so a length that very many pieces have
is no hot key.

Defined results: a null or empty text is one piece of the end id alone; repeated rows are packed each; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from quern.llm.common import Memo, map_slices, stored

MEMO_WORDS = 500_000
MEMO_CHARS = 64
CHUNK_WORDS = 4096
#: The least large length as a share of the capacity, and how many groups.
GROUPINGS = ((1 / 5, 96), (1 / 3, 96))
#: What a configuration's sequence may leave at most, as a share of the capacity; those that leave more lose their shortest piece.
MOST_LEFT = (0.0, 1 / 512, 1 / 128, 1 / 32, 1.0)


# --- pieces -------------------------------------------------------------------------------------------------------

_ENCODERS: dict[str, WordEncoder] = {}

# The steps before merging with which a word of lower-case Latin-1 letters goes to the merges as it is.
KNOWN_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
KNOWN_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
KNOWN_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: A capital that a mark may follow: NFC comes before lower-casing, and h, j, t, w and y compose where H, J, T, W and Y do not.
COMPOSED = re.compile(rb"[A-Z][\x80-\xff]")
#: Bytes that the byte-level alphabet does not show as themselves get the characters from 256 on, in order.
SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


class WordEncoder:
    """Ids of whole texts by a lower-casing word-level tokenizer, whose results a bounded memo keeps by word.

    The tokenizer drops white space before it merges and normalises no character across a blank, so a text's ids are
    those of its words in turn; a full stop or comma that ends a word after an ASCII letter or digit is a word of its
    own. Words that are not in the memo are handed to the tokenizer together.
    """

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(spec.decode())
        self.known = Memo(None, MEMO_WORDS)
        steps = json.loads(spec)
        known = {"type": "Sequence", "pretokenizers": [KNOWN_SPLIT, KNOWN_BYTES]}
        #: Texts are lower-cased ahead, which spares the memo, only for the normalizer that would do so itself.
        self.lowers = steps["normalizer"] == KNOWN_NORMALIZER
        #: Such words skip the tokenizer's other steps, which would leave them as they are.
        self.merges = self.tokenizer.model if steps["normalizer"] == KNOWN_NORMALIZER and steps["pre_tokenizer"] == known else None
        self.bar = self._ids_of(b"|")
        self.ends = {x: self._ids_of(x) for x in (b".", b",")}

    def _ids_of(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids).tobytes()

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words; those without a bar are handed over as one text, with bars between them."""
        found: dict[bytes, bytes] = {}
        if self.merges is not None:
            rest, merge = [], self.merges.tokenize
            for word in words:
                if word.isalpha() and word.islower():
                    found[word] = array("I", [t.id for t in merge(word.decode())]).tobytes()
                elif LETTERS.fullmatch(word.decode()):
                    found[word] = array("I", [t.id for t in merge(word.decode("latin-1").translate(SHOWN))]).tobytes()
                else:
                    rest.append(word)
            words = rest
        plain = [w for w in words if b"|" not in w]
        found |= {w: self._ids_of(w) for w in words if b"|" in w}
        if plain and len(self.bar) == 4:
            ids = np.frombuffer(self._ids_of(b" | ".join(plain)), "<u4")
            ends = [*(4 * np.flatnonzero(ids == np.frombuffer(self.bar, "<u4")[0])).tolist(), 4 * len(ids)]
            if len(ends) == len(plain):
                raw, at = ids.tobytes(), 0
                for word, end in zip(plain, ends, strict=True):
                    found[word] = raw[at:end]
                    at = end + 4
                return found
        return found | {w: self._ids_of(w) for w in plain}

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        raw = (text or "").encode()
        words = None
        if self.lowers and b"<|" not in raw:  # else it may name a special token, which case matters for
            if COMPOSED.search(raw):
                words = [w.lower() if w.isascii() else w for w in raw.split()]
            else:
                raw = raw.lower()
        if words is None:
            words = raw.split()
        get, out = self.known.get, []
        for at in range(0, len(words), CHUNK_WORDS):
            some = words[at : at + CHUNK_WORDS]
            found = list(map(get, some))
            if None in found:
                self._fill(some, found)
            out.append(b"".join(found))
        return b"".join(out)

    def _fill(self, words: list[bytes], found: list[bytes | None]) -> None:
        """Put the ids of the words that have none yet into found, and into the memo."""
        known, ends = self.known, self.ends
        missing = {words[i]: None for i, x in enumerate(found) if x is None}
        cut: dict[bytes, tuple[bytes, bytes]] = {}
        for word in missing:
            ids = known.find(word)
            if ids is None and word[-1:] in ends and word[-2:-1].isalnum():
                cut[word] = word[:-1], word[-1:]
                if (core := known.find(word[:-1])) is not None:
                    ids = core + ends[word[-1:]]
                    self._keep(word, ids)
            missing[word] = ids
        new = list({cut[w][0] if w in cut else w for w, x in missing.items() if x is None})
        fresh = self._encode(new)
        for word, ids in fresh.items():
            self._keep(word, ids)
        for word, ids in missing.items():
            if ids is None:
                missing[word] = fresh[word] if word not in cut else fresh[cut[word][0]] + ends[cut[word][1]]
                self._keep(word, missing[word])
        found[:] = [missing[w] if x is None else x for w, x in zip(words, found, strict=True)]

    def _keep(self, word: bytes, ids: bytes) -> None:
        if len(word) <= MEMO_CHARS:
            self.known.put(word, ids)


def encoder_of(spec: bytes) -> WordEncoder:
    """The encoder, built once a process."""
    key = hashlib.sha256(spec).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(spec)
    return _ENCODERS[key]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32. One pass over the texts, no shuffle."""
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        shipped = spark.sparkContext.broadcast(f.read())  # a tokenizer file, a few MB whatever the input
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType
    names = ("piece", "start", "length", "ids_crc32")
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("piece", pa.int32()), *((n, pa.int64()) for n in names[1:])])
    end = int(end_id).to_bytes(4, "little")

    def make():
        encoder = encoder_of(shipped.value)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner, rows = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.ids(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    owner.append(i)
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner)).cast(schema.field(0).type), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

        return kernel

    def done():
        encoder_of(shipped.value).known.forget()  # the worker may go on with other work

    return map_slices(source, schema, f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long", make, done)


# --- the plan -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Placement:
    """Ranks first_rank.. of the pieces of a length: each of the sequences first_sequence.. takes per of them in turn, from offset on."""

    length: int
    first_rank: int
    n: int
    first_sequence: int
    per: int
    offset: int


class _Plan:
    """Runs of sequences filled alike, by remainder, and the placements so far."""

    def __init__(self, capacity: int, counts: dict[int, int]):
        self.capacity, self.left = capacity, dict(counts)
        self.given: dict[int, int] = defaultdict(int)
        self.placements: list[Placement] = []
        self.n_sequences = self.grouped = 0
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remainder: (first sequence, how many)

    def place(self, length: int, sequences: int, first: int, per: int, offset: int, n: int | None = None) -> None:
        n = sequences * per if n is None else n
        self.placements.append(Placement(length, self.given[length], n, first, per, offset))
        self.given[length] += n
        self.left[length] -= n

    def new(self, n: int) -> int:
        first, self.n_sequences = self.n_sequences, self.n_sequences + n
        return first

    def best_fit(self) -> None:
        """All that is left, longest first, where it fits best."""
        for length in sorted((x for x, n in self.left.items() if n), reverse=True):
            while self.left[length]:
                fits = [r for r, runs in self.open.items() if r >= length and runs]
                if not fits:
                    per = self.capacity // length
                    self.open[self.capacity].append((self.new(-(-self.left[length] // per)), -(-self.left[length] // per)))
                    continue
                room = min(fits)
                first, n = self.open[room].pop()
                per = room // length
                offset, want = self.capacity - room, self.left[length]
                full = min(n, want // per)
                if full:
                    self.place(length, full, first, per, offset)
                    self.open[room - per * length].append((first, full))
                if full < n and self.left[length]:  # one sequence takes the last few
                    last = self.left[length]
                    self.place(length, 1, first + full, last, offset, last)
                    self.open[room - last * length].append((first + full, 1))
                    full += 1
                if full < n:
                    self.open[room].append((first + full, n - full))


def linear_groups(counts: dict[int, int], least: float, groups: int) -> list[list[tuple[int, int]]]:
    """Large lengths with counts, longest first, cut into groups of equal cardinality (a length may be in several)."""
    large = sorted(((x, n) for x, n in counts.items() if x >= least and n), reverse=True)
    total = sum(n for _, n in large)
    size = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length, n in large:
        while n:
            if not room:
                out.append([])
                room = size
            take = min(n, room)
            out[-1].append((length, take))
            n, room = n - take, room - take
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (how many of each size) with how many sequences use each, none beyond the demand.

    Column generation on the relaxed covering problem: the dual prices of the current configurations price a
    knapsack, whose best filling is the next configuration, until none would improve. Counts are rounded down.
    """
    k, need = len(sizes), np.array(demand, float)
    basis = np.diag([float(max(1, min(capacity // s, d))) for s, d in zip(sizes, demand, strict=True)])
    for _ in range(40 * k):
        inverse = np.linalg.inv(basis)
        column = _knapsack(sizes, inverse.sum(0), capacity)
        if column is None:
            break
        x, step = inverse @ need, inverse @ column
        ratios = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    x = np.floor(np.linalg.solve(basis, need) + 1e-9).astype(int)
    out, left = [], np.array(demand)
    for column, n in zip(basis.T.round().astype(int), x, strict=True):
        used = column > 0
        n = min(n, int((left[used] // column[used]).min())) if used.any() else 0
        if n > 0:
            out.append((tuple(int(c) for c in column), int(n)))
            left -= n * column
    return out


def _knapsack(sizes: list[int], price: np.ndarray, capacity: int) -> np.ndarray | None:
    """The filling of a sequence that is worth most, if worth more than one sequence."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, (size, worth) in enumerate(zip(sizes, price, strict=True)):
        if worth <= 1e-12:
            continue
        for at in range(size, capacity + 1, size):  # each stretch of rooms takes one more of this size than the last
            to = min(at + size, capacity + 1)
            gain = value[at - size : to - size] + worth
            better = gain > value[at:to] + 1e-12
            value[at:to][better] = gain[better]
            choice[at:to][better] = i
    if value[capacity] <= 1 + 1e-7:
        return None
    column, room = np.zeros(len(sizes)), int(np.argmax(value >= value[capacity] - 1e-12))
    while room > 0 and choice[room] >= 0:
        column[choice[room]] += 1
        room -= sizes[choice[room]]
    return column


def substituted(counts: dict[int, int], capacity: int, share: float, groups: int) -> list[tuple[int, tuple[int, ...]]]:
    """Runs of sequences, (how many, the lengths of their pieces): the configurations' places taken by actual pieces, longest first within a group."""
    made = linear_groups(counts, max(2, share * capacity), groups)
    out: list[tuple[int, tuple[int, ...]]] = []
    if not made:
        return out
    rounded = [g[0][0] for g in made]
    for config, times in configurations(rounded, [sum(n for _, n in g) for g in made], capacity):
        runs: list[tuple[int, tuple[int, ...]]] = [(times, ())]
        for slot in (i for i, n in enumerate(config) for _ in range(n)):
            cut = []
            for n, lengths in runs:
                while n:
                    length, there = made[slot][0]
                    take = min(n, there)
                    made[slot][0] = (length, there - take)
                    if take == there:
                        made[slot].pop(0)
                    cut.append((take, (*lengths, length)))
                    n -= take
            runs = cut
        out += runs
    return out


def _planned(counts: dict[int, int], capacity: int, runs: list[tuple[int, tuple[int, ...]]], most_left: int) -> _Plan:
    """The runs, whose shortest piece is taken out where they leave more than that; those pieces, and all the rest, where they fit best."""
    made = _Plan(capacity, counts)
    for n, lengths in runs:
        if capacity - sum(lengths) > most_left:
            lengths = tuple(sorted(lengths, reverse=True)[:-1])
        if not lengths:
            continue
        first, at = made.new(n), 0
        made.grouped += n
        for length in lengths:
            made.place(length, n, first, 1, at)
            at += length
        made.open[capacity - at].append((first, n))
    made.best_fit()
    return made


def planned(counts: dict[int, int], capacity: int = 2048) -> _Plan:
    """Of all groupings and bounds on what a configuration leaves, the plan with fewest sequences, then with most from configurations."""
    if bad := [x for x, n in counts.items() if not 1 <= x <= capacity or n < 0]:
        raise ValueError(f"lengths outside 1..{capacity}: {bad[:5]}")
    plans = []
    for grouping in GROUPINGS:
        runs = substituted(counts, capacity, *grouping)
        plans += [_planned(counts, capacity, runs, int(share * capacity)) for share in MOST_LEFT]
    return min(plans, key=lambda p: (p.n_sequences, -p.grouped))


def plan(counts: dict[int, int], capacity: int = 2048) -> tuple[list[Placement], int]:
    """The placements of all pieces, from the number of pieces of each length, and how many sequences they need."""
    found = planned(counts, capacity)
    return found.placements, found.n_sequences


# --- places -------------------------------------------------------------------------------------------------------


def ranked(found: DataFrame, buckets: int) -> DataFrame:
    """found with rank, from 0 among the pieces of one length.

    A length is cut into buckets by a hash of the piece; ranks are counted within a bucket and moved on by what the
    length's earlier buckets hold. The table of bucket sizes has at most ``capacity`` times ``buckets`` rows.
    """
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    salted = found.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    within = Window.partitionBy("length", "bucket").orderBy(*order)
    sizes = salted.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    local = salted.withColumn("local", F.row_number().over(within) - 1)
    return local.join(starts, ["length", "bucket"]).select(*found.columns, (F.col("base") + F.col("local")).alias("rank"))


def pack(found: DataFrame, capacity: int = 2048, buckets: int | None = None) -> DataFrame:
    """Pieces with sequence_id and offset. found is read twice: give a stored table."""
    spark = found.sparkSession
    counts = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    placements, _ = plan(counts, capacity)
    buckets = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by_length: dict[int, list[Placement]] = defaultdict(list)
    for p in placements:
        by_length[p.length].append(p)
    shipped = spark.sparkContext.broadcast({x: np.array([(p.first_rank, p.first_sequence, p.per, p.offset) for p in ps], np.int64) for x, ps in by_length.items()})
    rows = ranked(found, buckets)
    names = [*found.columns, "sequence_id", "offset"]
    schema = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in found.schema), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", sequence_id long, offset long"

    def make():
        table = shipped.value

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            lengths, ranks = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.empty((batch.num_rows, 2), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                own = table[length]
                first, sequence, per, offset = own[np.searchsorted(own[:, 0], ranks[rows], "right") - 1].T
                k = ranks[rows] - first
                at[rows, 0], at[rows, 1] = sequence + k // per, offset + k % per * length
            return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:-2]), pa.array(at[:, 0]), pa.array(at[:, 1])], names=names)

        return kernel

    return map_slices(rows, schema, ddl, make)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole documents to packed pieces; the pieces, a few numbers each, are stored in between."""
    return pack(stored(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces"), capacity)
