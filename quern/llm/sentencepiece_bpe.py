"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A piece sequence is the merge result of its text exactly when every two neighbours are compatible, that is when
merging the two pieces' joined text gives the two pieces again. So a text is encoded from the left: an Aho-Corasick
automaton gives the longest piece at a position; if it is compatible with the piece before, it is taken; if not, the
next shorter piece is tried; if none is left, the position is marked as failed in a bitfield and the last piece is
taken back. Compatibility is found by merging the two pieces anew, and remembered.

This needs one priority a merge. Pieces of blanks alone share one score in some models; a chunk with a run of blanks is
therefore merged outright by the same routine that decides compatibility.

A text is first cut into chunks that no merge can cross: before each run of blanks, if no piece has a blank after
another character, and around characters that no piece has, which become byte pieces. Chunks repeat, so their results
are kept in a bounded memo.

Covered are merge-type models with the identity normaliser, byte fallback and no user-defined pieces; others are
refused. Defined results: a null or empty text has no pieces and decodes to the empty text; texts of any length are encoded whole;
of merges with equal scores the leftmost comes first, as in the library; repeated rows and null ids are rows of their
own; extra columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from quern.llm.common import Memo, map_slices

BLANK = "▁"
MEMO_CHUNKS, MEMO_PAIRS = 300_000, 400_000
#: Longer chunks hardly repeat and are not kept.
MEMO_CHARS = 64
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Models by digest, so that a worker process reads each once.
_MODELS: dict[str, Model] = {}


class Model:
    """A vocabulary with what the encoder needs of it."""

    def __init__(self, proto: bytes):
        spec = model_pb2.ModelProto()
        spec.ParseFromString(proto)
        self._require(spec)
        self.pieces = [p.piece for p in spec.pieces]
        self.kinds = [p.type for p in spec.pieces]
        self.dummy_prefix = spec.normalizer_spec.add_dummy_prefix
        self.score = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        kinds = {NORMAL: None, CONTROL: "", UNKNOWN: " ⁇ "}
        self.shown = [None if k == BYTE else kinds[k] if kinds[k] is not None else p.replace(BLANK, " ") for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.known = {c for p in self.score for c in p if c in self.score}
        self.longest = max(map(len, self.score))
        by_score = sorted(self.score.values())
        self.tied = {a for a, b in zip(by_score, by_score[1:], strict=False) if a == b}
        # Only pieces that merging can give take part in the search, and none of tied priority.
        self.reached = {p for p, s in self.score.items() if all(c in self.known for c in p) and s not in self.tied and self.merge(p) == [p]}
        self.shorter: dict[str, str] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.reached:
            self.automaton.add_word(piece, (len(piece) - 1, piece))
        for piece in self.reached:
            self.shorter[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.reached), "")
        self.automaton.make_automaton()
        self.unknown = re.compile("([^" + re.escape("".join(sorted(self.known))) + "])")
        self.pairs = Memo(self._compatible, MEMO_PAIRS)
        self.words = Memo(self._word, MEMO_CHUNKS, MEMO_CHARS)
        self.chunks = Memo(self._chunk, MEMO_CHUNKS // 10, MEMO_CHARS)
        # No merge crosses two characters that stand side by side in no piece.
        self.neighbours = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}

    @staticmethod
    def _require(spec) -> None:
        norm, pieces = spec.normalizer_spec, [p for p in spec.pieces if p.type == NORMAL]
        for ok, what in (
            (spec.trainer_spec.model_type == 2, "it is not of the merge type"),
            (spec.trainer_spec.byte_fallback, "it has no byte fallback"),
            (not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces, "it normalises texts"),
            (not spec.trainer_spec.treat_whitespace_as_suffix, "blanks end its pieces"),
            (all(p.type in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in spec.pieces), "it has user-defined pieces"),
            (not any(BLANK in p.piece.lstrip(BLANK) for p in pieces), "a piece has a blank after another character"),
            (any(p.piece == BLANK for p in pieces), "it has no blank piece"),
            (not any("\n" in p.piece for p in pieces), "a piece has a line end"),
        ):
            if not ok:
                raise ValueError(f"this model is not covered: {what}")

    def merge(self, text: str) -> list[str]:
        """The pieces of a text of known characters, by merging the best pair, the leftmost of equals, again and again."""
        part: list[str | None] = list(text)
        left, right = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        score, queue = self.score, []

        def offer(i: int, j: int) -> None:
            both = part[i] + part[j]
            if both in score:
                heapq.heappush(queue, (-score[both], i, j, both))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if part[i] is None or part[j] is None or right[i] != j or part[i] + part[j] != both:
                continue
            part[i], part[j], right[i] = both, None, right[j]
            if right[i] < len(text):
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return [p for p in part if p is not None]

    def _compatible(self, pair: tuple[str, str]) -> bool:
        return self.merge(pair[0] + pair[1]) == list(pair)

    def _longest(self, text: str) -> list[str]:
        """The longest piece of the vocabulary at each position of a text, from one pass of the automaton."""
        found = [""] * len(text)
        for end, (back, piece) in self.automaton.iter(text):
            found[end - back] = piece  # of one start, longer matches end later
        return found

    def encode_chunk(self, text: str) -> list[str]:
        """The pieces of a text of known characters, by backtracking."""
        if text in self.reached:
            return [text]
        if BLANK * 2 in text:
            return self.merge(text)
        longest, end = self._longest(text), len(text)
        failed, taken, at = bytearray(end // 8 + 1), [], 0
        piece = longest[0]
        while at < end:
            before = taken[-1] if taken else None
            while piece and (failed[(to := at + len(piece)) >> 3] >> (to & 7) & 1 or before is not None and not self.pairs[before, piece]):
                piece = self.shorter[piece]
            if piece:
                taken.append(piece)
                at += len(piece)
                piece = longest[at] if at < end else ""
            elif taken:
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= len(piece)
                piece = self.shorter[piece]
            else:
                return self.merge(text)  # only if a tied piece is needed
        return taken

    def _ids(self, text: str) -> list[int]:
        """The ids of a normalised text."""
        found: list[int] = []
        for i, part in enumerate(self.unknown.split(text)):
            if i % 2:
                found += [self.bytes[b] for b in part.encode()]
            elif part:
                found += [self.ids[p] for p in self.encode_chunk(part)]
        return found

    def _chunk(self, text: str) -> tuple[int, str, str]:
        """How many ids a chunk has, the ids joined by commas, and what they decode to."""
        ids = self._ids(text)
        return len(ids), ",".join(map(str, ids)), self.surface(ids)

    def _word(self, word: str) -> tuple[int, str, str]:
        """The chunk of a word after a blank, or of one that begins with a line end, which no blank leads."""
        if 2 < len(word) <= MEMO_CHARS and word[-1] in ".,;:!?" and word[-2:] not in self.neighbours:
            n, ids, shown = self.words[word[:-1]]  # the mark is a chunk of its own
            end_n, end_ids, end_shown = self.chunks[word[-1]]
            return n + end_n, f"{ids},{end_ids}", shown + end_shown
        return self._chunk(word if word[0] == "\n" else BLANK + word)

    def surface(self, ids: list[int]) -> str:
        """What ids stand for, with blanks as spaces, before a leading one is dropped."""
        shown = [self.shown[i] for i in ids]
        if None not in shown:
            return "".join(shown)
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.kinds[i] == BYTE:
                run.append(int(self.pieces[i][3:-1], 16))
                continue
            if run:
                out.append(_replaced(bytes(run)))
                run.clear()
            if i >= 0:
                out.append(self.shown[i])
        return "".join(out)

    def pieces_of(self, text: str) -> list[tuple[int, str, str]]:
        """The results of a text's chunks, in order, none crossed by a merge: it is cut before blanks and line ends."""
        words = text.replace(BLANK, " ").replace("\n", " \n").split(" ")
        if self.dummy_prefix and "" not in words and words[0][0] != "\n":
            return list(map(self.words.__getitem__, words))
        full = (BLANK if self.dummy_prefix else "") + text.replace(" ", BLANK)
        return list(map(self.chunks.__getitem__, re.findall(f"{BLANK}*\n?[^{BLANK}\n]+|{BLANK}+|\n", full)))

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text."""
        return [int(x) for _, ids, _ in self.pieces_of(text) for x in ids.split(",")] if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        text = self.surface(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), -1)  # only a piece's blank is the prefix, not a byte's
        led = first >= 0 and self.kinds[first] == NORMAL and self.pieces[first][0] == BLANK
        return text[1:] if self.dummy_prefix and led else text

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, hash of the joined ids, hash of the decoded text."""
        if not text:
            return 0, _sha256(""), _sha256("")
        n, ids, shown = zip(*self.pieces_of(text), strict=True)
        decoded = "".join(shown)
        if self.dummy_prefix and decoded[:1] == " ":
            decoded = decoded[1:]
        return sum(n), _sha256(",".join(ids)), _sha256(decoded)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _replaced(raw: bytes) -> str:
    """Bytes as UTF-8, each byte that is part of no character as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def model_of(proto: bytes) -> Model:
    """The model, built once a process."""
    key = hashlib.sha256(proto).hexdigest()
    if key not in _MODELS:
        _MODELS[key] = Model(proto)
    return _MODELS[key]


def _mapped(docs: DataFrame, model_path: str, id_col: str, in_col: str, fields: list[pa.Field], ddl: str, kernel_of) -> DataFrame:
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        shipped = spark.sparkContext.broadcast(f.read())  # a model file, a few MB whatever the input
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(in_col).alias("input"))
    kind = source.schema["doc_id"].dataType
    schema = pa.schema([pa.field("doc_id", to_arrow_type(kind)), *fields])

    def make():
        of = kernel_of(model_of(shipped.value))

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = list(zip(*map(of, batch.column("input").to_pylist()), strict=True))
            return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(schema.field(0).type), *(pa.array(x, f.type) for x, f in zip(rows, fields, strict=True))], schema=schema)

        return kernel

    return map_slices(source, schema, f"doc_id {kind.simpleString()}, {ddl}", make)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of each whole text."""
    return _mapped(docs, model_path, id_col, text_col, [pa.field("ids", pa.list_(pa.int32()))], "ids array<int>", lambda m: lambda text: (m.encode(text),))


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of each row's ids; null ids give the empty text."""
    return _mapped(encoded, model_path, id_col, ids_col, [pa.field("text", pa.string())], "text string", lambda m: lambda ids: (m.decode(ids or []),))


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text, without moving either out of the worker."""
    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    return _mapped(docs, model_path, id_col, text_col, fields, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda m: m.digest)
