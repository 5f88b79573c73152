"""Operator 9, packing of tokenised documents into sequences by balanced attention cost.

A document is its ids and an end id.  Its full stretches of ``capacity`` ids are
sequences of their own.  What remains of each document is collected by the task
that reads it into windows of about ``window`` ids and packed there: pieces in
descending length, each to the sequence of the lowest estimated cost
(``linear * n + quadratic * n**2`` for a piece of n ids, added up per sequence)
that has capacity left; a piece that does not fit is cut.  A sequence that a
window leaves unfilled gives its pieces back to the next window, so only the
last sequence of a task is padded.

Nothing is shuffled and a task holds one window.  Sequence ids carry the number
of the task's partition, so they are unique and the same after a retry.

Null and empty texts are their end id alone.  Repeated rows are packed as often
as they stand there.  An empty table gives an empty result; only the key and
text columns are used, so further columns cannot clash.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import pieces as pc_text
from loomwork.llm import vectorwords as vw

CAPACITY = 1024
WINDOW = 1 << 20
END_ID = 0
LINEAR, QUADRATIC = 1.0, 1.0 / 512
_KNOWN = 400_000       # pieces whose ids a task remembers


class ByteEncoder(dict):
    """Ids of pieces (as little-endian 32-bit bytes) under a byte-level vocabulary, remembered."""

    def __init__(self, vocabulary: pc_text.Vocabulary):
        super().__init__()
        import tiktoken  # executors need it, the driver does not

        alphabet = {c: b for b, c in pc_text.byte_alphabet().items()}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.ids.items()
                 if token not in vocabulary.special}
        core = tiktoken.Encoding("pieces", pat_str=pc_text.BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})._core_bpe
        self.ranks, self.encode_piece = ranks, core.encode_single_piece
        self.cutter = pc_text.Cutter(
            vocabulary.special, pc_text.BYTE_LEVEL_PATTERN, ascii_pattern=pc_text.BYTE_LEVEL_ASCII)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= _KNOWN:
            self.clear()
        raw = piece.encode()
        whole = self.ranks.get(raw)
        ids = self.encode_piece(raw) if whole is None else [whole]
        out = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str) -> np.ndarray:
        parts = []
        for stretch in self.cutter.stretches(text):
            if isinstance(stretch, int):
                parts.append(np.array([stretch], dtype="<u4").tobytes())
            else:
                parts.append(b"".join(map(self.__getitem__, stretch)))
        return np.frombuffer(b"".join(parts), dtype="<u4")


class Piece(NamedTuple):
    """A stretch of a document's ids."""
    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (self._replace(ids=self.ids[:n]), self._replace(start=self.start + n, ids=self.ids[n:]))


def balance(pieces: list[Piece], capacity: int, linear: float = LINEAR,
            quadratic: float = QUADRATIC) -> list[list[Piece]]:
    """Sequences of at most ``capacity`` ids; all but the last are full."""
    total = sum(len(p.ids) for p in pieces)
    count, over = divmod(total, capacity)
    room = [capacity] * count + ([over] if over else [])
    packed: list[list[Piece]] = [[] for _ in room]
    # a sequence with less room starts with the cost of what it lacks, so none is preferred for being short
    lacking = capacity - over
    heap = [(0.0, k) for k in range(count)] + ([(linear * lacking, count)] if over else [])
    heapq.heapify(heap)
    for piece in sorted(pieces, key=lambda p: -len(p.ids)):
        while len(piece.ids):
            cost, k = heapq.heappop(heap)
            head, piece = piece.cut(min(len(piece.ids), room[k]))
            packed[k].append(head)
            n = len(head.ids)
            room[k] -= n
            if room[k]:
                heapq.heappush(heap, (cost + linear * n + quadratic * n * n, k))
    return packed


class _Packer:
    """Packs one task's documents; ``take`` and ``finish`` return rows ready for output."""

    def __init__(self, base: int, capacity: int, window: int):
        self.next_id, self.capacity, self.window = base, capacity, window
        self.waiting: list[Piece] = []
        self.tokens = 0

    def _rows(self, sequence: list[Piece]) -> list[tuple]:
        at, rows = 0, []
        for p in sequence:
            rows.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, self.next_id, at))
            at += len(p.ids)
        self.next_id += 1
        return rows

    def take(self, doc: int | None, ids: np.ndarray) -> list[tuple]:
        rows: list[tuple] = []
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            rows += self._rows([Piece(doc, start, ids[start:start + self.capacity], len(ids))])
        if whole < len(ids):
            # a copy, so that the whole document is not kept alive
            self.waiting.append(Piece(doc, whole, ids[whole:].copy(), len(ids)))
            self.tokens += len(ids) - whole
        if self.tokens >= self.window:
            rows += self.flush()
        return rows

    def flush(self, last: bool = False) -> list[tuple]:
        rows: list[tuple] = []
        packed = balance(self.waiting, self.capacity)
        self.waiting, self.tokens = [], 0
        for sequence in packed:
            size = sum(len(p.ids) for p in sequence)
            if size < self.capacity and not last:
                self.waiting, self.tokens = sequence, size
            else:
                rows += self._rows(sequence)
        return rows


COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(pc_text.read_vocabulary(vocabulary)))
    names = [key, *COLUMNS]

    def work(batches):
        encoder = ByteEncoder(pc_text.Vocabulary(*shared.value))
        packer = _Packer(TaskContext.get().partitionId() << 36, capacity, window)
        end = np.array([end_id], dtype="<u4")

        def made(rows):
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in vw.slices(batches):
            rows: list[tuple] = []
            texts = pc.fill_null(batch.column(1), "")
            for doc, words in zip(batch.column(0).to_pylist(), texts):
                rows += packer.take(doc, np.concatenate([encoder.encode(words.as_py()), end]))
            yield made(rows)
        yield made(packer.flush(last=True))

    schema = ", ".join(f"`{n}` bigint" for n in names)
    return docs.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("text")).mapInArrow(
        work, schema)
