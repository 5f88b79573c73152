"""Operator 7, byte-pair encoding and decoding with an index of pair occurrences.

A task collects the distinct pieces of a slice of texts that it has not met
before and lays their symbols out in one array.  An index maps each mergeable
pair to all its positions there.  Ranks that occur are applied in ascending order:
all positions of the pair are merged, and the lists of the pairs that this makes
or breaks are updated (a broken position is recognised when its turn comes).
Whole texts are then put together from the remembered ids of their pieces.

Decoding joins the token strings by a space, as a vocabulary file without a
decoder asks.  Nulls count as empty texts: no tokens, empty decoded text.  Repeated
rows give repeated results.  An empty table gives an empty result; only the key
and text columns are used, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import pieces as pc_text
from loomwork.llm import vectorwords as vw

_KNOWN = 400_000       # pieces that a task remembers


class PairIndex:
    """Merges of a vocabulary over the symbols of many pieces at once."""

    def __init__(self, vocabulary: pc_text.Vocabulary):
        ids = vocabulary.ids
        self.ids = ids
        self.end = vocabulary.word_end
        self.alphabet = {b: c for b, c in pc_text.byte_alphabet().items()}
        # (left id, right id) as one number -> (rank, id of the merged token)
        self.merge = {}
        for rank, (a, b) in enumerate(vocabulary.merges):
            if a in ids and b in ids and a + b in ids:
                self.merge.setdefault(ids[a] << 32 | ids[b], (rank, ids[a + b]))
        self.pair_of = {rank: (pair, new) for pair, (rank, new) in self.merge.items()}

    def symbols(self, piece: str) -> list[int]:
        chars = [self.alphabet[b] for b in piece.encode()]
        chars[-1] += self.end
        return [self.ids[c] for c in chars]

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each (non-empty) piece."""
        made = [self.symbols(p) for p in pieces]
        sizes = np.array([len(m) for m in made], dtype=np.int64)
        ends = np.cumsum(sizes)
        symbol = list(chain.from_iterable(made))
        n = len(symbol)
        after = list(range(1, n + 1))      # next symbol of the same piece, -1 at its end
        before = list(range(-1, n - 1))    # previous one, -1 at its start
        for e in ends.tolist():
            after[e - 1] = -1
            if e < n:
                before[e] = -1
        merge = self.merge
        places: dict[int, list[int]] = {}  # rank -> positions of its pair
        for p in range(n):
            q = after[p]
            if q >= 0:
                found = merge.get(symbol[p] << 32 | symbol[q])
                if found is not None:
                    places.setdefault(found[0], []).append(p)
        ranks = list(places)
        heapq.heapify(ranks)
        while ranks:
            rank = heapq.heappop(ranks)
            pair, new = self.pair_of[rank]
            left, right = pair >> 32, pair & 0xFFFFFFFF
            spots = places.pop(rank)
            if left == right:
                spots.sort()               # a run of one symbol merges from its left end
            for p in spots:
                q = after[p]
                if q < 0 or symbol[p] != left or symbol[q] != right:
                    continue               # broken by an earlier merge
                symbol[p], symbol[q] = new, -1
                r = after[p] = after[q]
                if r >= 0:
                    before[r] = p
                    found = merge.get(new << 32 | symbol[r])
                    if found is not None:
                        if found[0] in places:
                            places[found[0]].append(p)
                        else:
                            places[found[0]] = [p]
                            heapq.heappush(ranks, found[0])
                o = before[p]
                if o >= 0:
                    found = merge.get(symbol[o] << 32 | new)
                    if found is not None:
                        if found[0] in places:
                            places[found[0]].append(o)
                        else:
                            places[found[0]] = [o]
                            heapq.heappush(ranks, found[0])
        out, at = [], 0
        for e in ends.tolist():
            out.append([s for s in symbol[at:e] if s >= 0])
            at = e
        return out


class Encoder:
    """Encodes texts; remembers ids (as little-endian bytes) and decoded strings of pieces."""

    def __init__(self, vocabulary: pc_text.Vocabulary):
        self.index = PairIndex(vocabulary)
        self.cutter = pc_text.Cutter(vocabulary.special, pc_text.WORD_PATTERN, pc_text.word_normal)
        self.token = {i: t for t, i in [*vocabulary.ids.items(), *vocabulary.special.items()]}
        self.ids: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}

    def learn(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.ids))
        if len(self.ids) + len(new) > _KNOWN:
            self.ids.clear()
            self.shown.clear()
            new = list(pieces)
        for piece, ids in zip(new, self.index.encode(new)):
            self.ids[piece] = np.array(ids, dtype="<u4").tobytes()
            self.shown[piece] = " ".join([self.token[i] for i in ids])

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids, decoded text) of each text."""
        cut = [self.cutter.stretches(t) for t in texts]
        lists = [s for stretches in cut for s in stretches if not isinstance(s, int)]
        self.learn(set(chain.from_iterable(lists)))
        out = []
        for stretches in cut:
            raw, shown = [], []
            for s in stretches:
                if isinstance(s, int):
                    raw.append(np.array([s], dtype="<u4").tobytes())
                    shown.append(self.token[s])
                else:
                    raw.extend(map(self.ids.__getitem__, s))
                    shown.extend(map(self.shown.__getitem__, s))
            out.append((b"".join(raw), " ".join(shown)))
        return out


def encode_decode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                  content: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256); with ``content`` also ids (array) and decoded (string)."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(pc_text.read_vocabulary(vocabulary)))
    fields = {key: "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    if content:
        fields |= {"ids": "array<bigint>", "decoded": "string"}

    def work(batches):
        encoder = Encoder(pc_text.Vocabulary(*shared.value))
        for batch in vw.slices(batches):
            found = encoder.encode(pc.fill_null(batch.column(1), "").to_pylist())
            columns = [batch.column(0), pa.array([len(i) // 4 for i, _ in found], pa.int64()),
                       pa.array([hashlib.sha256(i).hexdigest() for i, _ in found], pa.string()),
                       pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in found], pa.string())]
            if content:
                columns += [pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i, _ in found],
                                     pa.list_(pa.int64())),
                            pa.array([d for _, d in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, list(fields))

    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    return docs.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("text")).mapInArrow(
        work, schema)
