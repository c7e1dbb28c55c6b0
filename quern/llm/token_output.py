"""Packed token-id output: best-fit-decreasing packing with a segment-tree capacity search.

Texts become ids, closed by the end id; documents longer than the capacity are split without loss. A task packs windows
of at most ``window`` pieces, longest first: a segment tree over remaining capacities gives the fullest open sequence a
piece fits. A sequence is a row of an id matrix (little-endian 32-bit, padded), with the cumulative lengths of its
segments and positions that begin anew in each. No shuffle; memory is bounded by the window. Windows end with
sequences of their own, so how many sequences there are depends on how the input is split, while no piece ever does.

Defined results: a null or empty text is the end id alone; a text of any length is encoded whole and split without
loss; repeated rows and null ids are packed each, and ids keep their type; of equally long pieces the first is placed
first; extra columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.common import trim_memory
from quern.llm.packing import encoder_of

SEQUENCES = "sequence_id long, ids binary, cu_seqlens array<int>, positions binary, doc_ids array<{}>, pieces array<int>"
#: Sequences that are handed on together.
BATCH_SEQUENCES = 64


class Capacities:
    """Open sequences by remaining capacity; a segment tree of counts finds the least capacity that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: dict[int, list[int]] = {}

    def _add(self, capacity: int, by: int) -> None:
        at = capacity + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, capacity: int, sequence: int) -> None:
        self.open.setdefault(capacity, []).append(sequence)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the least capacity of at least ``least``, taken out; None if there is none."""
        at = least + self.size
        while not self.count[at]:
            while at & 1:  # no right neighbour below this parent
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.size
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of piece numbers, in the order they were placed."""
    tree, out = Capacities(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room, sequence = tree.take(lengths[i]) or (capacity, len(out))
        if sequence == len(out):
            out.append([])
        out[sequence].append(i)
        tree.put(room - lengths[i], sequence)
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, pad_id: int = 0, window: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a sequence: its padded ids, cumulative segment lengths, positions, and the documents and pieces in it."""
    with open(tokenizer_path, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())  # a tokenizer file, a few MB whatever the input
    end, pad = (int(x).to_bytes(4, "little") for x in (end_id, pad_id))
    ramp = np.arange(capacity, dtype="<u4").tobytes()
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["doc_id"].dataType
    names = [c.split()[0] for c in SEQUENCES.split(", ")]
    kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(to_arrow_type(kind)), pa.list_(pa.int32()))

    def run(batches):
        encoder, base, n, held = encoder_of(shipped.value), TaskContext.get().partitionId() << 33, 0, []

        def packed():
            nonlocal n
            plan = best_fit_decreasing([len(p[2]) // 4 for p in held], capacity)
            for at in range(0, len(plan), BATCH_SEQUENCES):
                rows = {c: [] for c in names}
                for members in plan[at : at + BATCH_SEQUENCES]:
                    sizes = [len(held[i][2]) // 4 for i in members]
                    spare = capacity - sum(sizes)
                    rows["sequence_id"].append(base + n)
                    rows["ids"].append(b"".join([*(held[i][2] for i in members), pad * spare]))
                    rows["cu_seqlens"].append(list(accumulate(sizes, initial=0)))
                    rows["positions"].append(b"".join([*(ramp[: 4 * s] for s in sizes), bytes(4 * spare)]))
                    rows["doc_ids"].append([held[i][0] for i in members])
                    rows["pieces"].append([held[i][1] for i in members])
                    n += 1
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=names)
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encoder.ids(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    held.append((doc_id.as_py(), k, ids[at : at + 4 * capacity]))
                    if len(held) >= window:
                        yield from packed()
            pa.default_memory_pool().release_unused()
        if held:
            yield from packed()
        trim_memory()

    return source.mapInArrow(run, SEQUENCES.format(kind.simpleString()))


def unpacked(rows: list, capacity: int) -> dict[tuple[int, int], bytes]:
    """The ids of each (document, piece), read back from collected sequences; checks positions and padding on the way."""
    out = {}
    for r in rows:
        positions = np.frombuffer(r.positions, "<u4")
        if len(r.ids) != 4 * capacity or len(positions) != capacity:
            raise ValueError(f"sequence {r.sequence_id} is not a row of the matrix")
        for doc_id, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            if (positions[a:b] != np.arange(b - a)).any():
                raise ValueError(f"positions of sequence {r.sequence_id} do not begin anew")
            out[doc_id, piece] = bytes(r.ids[4 * a : 4 * b])
    return out
