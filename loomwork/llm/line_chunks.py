"""Operator 8, line dedup by runs of lines, or by content-defined chunks of lines.

``dedup_runs`` removes every repeated run of two or more lines whole.  Texts are cut
into content-defined chunks (below).  A chunk with two lines or more that occurs again
goes where it is not the first (smallest id, then place).  So that no run is lost to the
borders, matches go on line by line: each line and the next one that is not blank
make a pair (blank lines between included), compared at every offset of the
chunks' first places and across all borders.  A pair stays where it occurs first;
elsewhere both lines go.  A run that stands elsewhere is the union of its pairs, so
all of it goes and no line beyond it, and of every line one copy stays; where the
borders are makes no difference.  Blank lines do not count as lines of a run.  Single
lines stay.  Rows that share an id lose a stretch only where they hold it.
Chunks and pairs whose 128-bit digest repeats are candidates; their bytes are fetched
from the texts and compared, and only what equals the first place goes.

``dedup_lines`` compares chunks only, which is coarser: a text is cut into lines and every line hashed.  A rolling hash over the last
``span`` line hashes decides where a chunk ends (when it falls into one of
``every`` residues, or after ``most`` lines), so the borders depend on the lines
near them only: a passage that stands elsewhere, or behind other lines, is cut
alike.  A chunk of several lines that occurs more than once anywhere in the corpus
is kept where it occurs first (smallest id, then place) and removed elsewhere.

Chunks are grouped by hash and bytes, so one is removed only when its bytes are the
same.  Grouping is by partial aggregates: a chunk that stands in a third of the
documents costs each task one row.  Texts are shuffled twice, once as chunks and
once to meet the list of what goes.

Single-line chunks stay.  Lines are what ``\\n`` separates; a removed chunk goes
with its line ends.  A null text stays null, an empty one empty.  Rows that repeat
an id: the rows count as places of one document, equal rows lose the same chunks.
A row without an id is left as it is.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm import vectorwords as vw
from loomwork.llm.columns import unused
from loomwork.session import materialize

SPAN = 2       # lines that decide a border
EVERY = 4      # one line in so many ends a chunk
MOST = 64      # lines in a chunk at most


class Chunks:
    """The chunks of a batch of texts: byte places, line counts and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, span: int, every: int, most: int):
        newline = np.flatnonzero(data == 0x0A) + 1
        filled = np.diff(offsets) > 0
        start = np.unique(np.concatenate([offsets[:-1][filled], newline]))
        start = start[start < len(data)]
        end = np.append(start[1:], len(data))
        bare = end - (data[end - 1] == 0x0A) if len(start) else end
        line = vw.hash_spans(data, start, bare)
        text = np.searchsorted(offsets, start, side="right") - 1
        opens = np.ones(len(start), dtype=bool)
        opens[1:] = text[1:] != text[:-1]
        rolled = np.zeros(len(start), dtype=np.uint64)
        for k in range(span):
            back = line[:len(line) - k] * np.uint64(2 * k + 3)
            rolled[k:] += np.where(text[k:] == text[:len(text) - k], back, np.uint64(0))
        wanted = vw.mix(rolled) % np.uint64(every) == 0
        closes = _spaced(wanted, opens)
        begin = np.concatenate([[0], np.flatnonzero(closes)[:-1] + 1]).astype(np.int64) if len(start) else \
            np.zeros(0, dtype=np.int64)
        stop = np.flatnonzero(closes) + 1
        begin, stop = _capped(begin, stop, most)
        self.text, self.lines = text[begin] if len(begin) else begin, stop - begin
        self.start = start[begin] if len(begin) else begin
        self.end = end[stop - 1] if len(begin) else begin
        self.bare_end = bare[stop - 1] if len(begin) else begin
        self.hash = vw.as_long(vw.hash_spans(data, self.start, self.bare_end))
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))


def _spaced(wanted: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The lines that end a chunk, so that chunks have two lines (a text of one line is one chunk).

    In a run of wanted borders every second one counts: from its first on, or from its
    second if it begins with the text.  A last line joins the chunk before it.
    """
    if len(wanted) == 0:
        return wanted
    number = np.arange(len(wanted))
    begins = wanted & opens
    begins[1:] |= wanted[1:] & ~wanted[:-1]
    run = np.maximum.accumulate(np.where(begins, number, 0))
    closes = wanted & ((number - run) % 2 == opens[run])
    last = np.append(opens[1:], True)
    closes[:-1] &= ~last[1:] | last[:-1]
    return closes | last


def _capped(begin: np.ndarray, stop: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut chunks of more than ``most`` lines into equal parts."""
    if len(begin) == 0 or (stop - begin).max() <= most:
        return begin, stop
    size = stop - begin
    parts = -(-size // most)
    place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    size, begin, parts = np.repeat(size, parts), np.repeat(begin, parts), np.repeat(parts, parts)
    return begin + place * size // parts, begin + (place + 1) * size // parts


def chunks(docs: DataFrame, key: str, text: str, span: int, every: int, most: int, content: bool) -> DataFrame:
    """(id, place, hash) of every multi-line chunk, with ``content`` also its bytes."""
    def work(batches):
        for batch in vw.slices(batches):
            data, offsets = vw.column_bytes(batch.column(1))
            found = Chunks(data, offsets, span, every, most)
            many = np.flatnonzero(found.lines > 1)
            columns = [batch.column(0).take(pa.array(found.text[many])),
                       pa.array(many - found.first[found.text[many]], pa.int64()), pa.array(found.hash[many])]
            if content:
                raw = memoryview(data)
                columns.append(pa.array([bytes(raw[a:b]) for a, b in zip(found.start[many], found.bare_end[many])],
                                        pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "place", "hash", "bytes"][:len(columns)])

    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    schema = "id bigint, place bigint, hash bigint" + (", bytes binary" if content else "")
    return rows.where("id is not null").mapInArrow(work, schema)


def removals(docs: DataFrame, key: str, text: str, span: int, every: int, most: int) -> DataFrame:
    """(id, _gone): the places of the chunks to remove from each document, confirmed byte by byte."""
    how = (docs, key, text, span, every, most)
    place = F.struct("id", "place")
    same = chunks(*how, content=True).groupBy("hash", "bytes").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    # a row per hash: how many byte strings share it, and the first place if it is one
    hashes = materialize(
        same.groupBy("hash").agg(F.count("*").alias("texts"), F.max("n").alias("n"), F.min("first").alias("first"))
        .where("n > 1"), "hashes")
    spots = chunks(*how, content=False)
    gone = spots.join(hashes.where("texts = 1").select("hash", "first"), "hash")
    mixed = hashes.where("texts > 1").select("hash")
    if not mixed.isEmpty():      # one hash for several byte strings: the bytes decide
        held = materialize(chunks(*how, content=True).join(mixed, "hash"), "mixed")
        firsts = held.groupBy("hash", "bytes").agg(F.min(place).alias("first"))
        gone = gone.unionByName(held.join(firsts, ["hash", "bytes"]).drop("bytes"))
    return gone.where(place != F.col("first")).groupBy("id").agg(F.collect_set("place").alias("_gone"))


def _without(column: pa.Array, gone: list[list[int] | None], span: int, every: int,
             most: int) -> tuple[pa.Array, np.ndarray]:
    """The texts without the chunks at the given places, and the lines that went."""
    data, offsets = vw.column_bytes(column)
    found = Chunks(data, offsets, span, every, most)
    raw = memoryview(data)
    texts, lost = column.to_pylist(), np.zeros(len(gone), dtype=np.int64)
    for i, places in enumerate(gone):
        if not places:
            continue
        first, last = int(found.first[i]), int(found.first[i + 1])
        out = np.zeros(last - first, dtype=bool)
        out[[p for p in places if p < last - first]] = True   # rows that share an id may be shorter
        rest = b"".join([raw[found.start[c]:found.end[c]] for c in range(first, last) if not out[c - first]])
        if out.size and out[-1] and rest.endswith(b"\n"):
            rest = rest[:-1]       # the line end before a removed tail
        texts[i] = rest.decode()
        lost[i] = found.lines[first:last][out].sum()
    return pa.array(texts, pa.string()), lost


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, every: int = EVERY,
                most: int = MOST, count: str | None = None) -> DataFrame:
    """All columns of ``docs``, the text without repeated chunks; ``count`` names a column for the lines removed."""
    names = docs.columns
    place = names.index(text)
    id_, mark = unused(docs, "_id"), unused(docs, "_gone")
    gone = removals(docs, key, text, span, every, most).select(F.col("id").alias(id_), F.col("_gone").alias(mark))
    marked = docs.withColumn(id_, F.col(key).cast("bigint")).join(gone, id_, "left").select(*names, mark)
    fields = [f"`{n}` {t}" for n, t in docs.dtypes] + ([f"`{count}` bigint"] if count else [])

    def work(batches):
        for batch in vw.slices(batches, text):
            columns = [*batch.columns[:len(names)]]
            lists = batch.column(len(names)).to_pylist()
            lost = np.zeros(batch.num_rows, dtype=np.int64)
            if any(lists):
                columns[place], lost = _without(columns[place], lists, span, every, most)
            extra = [pa.array(lost, pa.int64())] if count else []
            yield pa.RecordBatch.from_arrays(columns + extra, names + ([count] if count else []))

    return marked.mapInArrow(work, ", ".join(fields))


class Pairs:
    """The lines of a batch of texts, and every line with the next one that is not blank."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        newline = np.flatnonzero(data == 0x0A) + 1
        filled = np.diff(offsets) > 0
        start = np.unique(np.concatenate([offsets[:-1][filled], newline]))
        self.start = start[start < len(data)]
        self.end = np.append(self.start[1:], len(data))[:len(self.start)]
        self.bare = self.end - (data[self.end - 1] == 0x0A)
        text = np.searchsorted(offsets, self.start, side="right") - 1
        self.first = np.searchsorted(text, np.arange(len(offsets)))
        letters = np.concatenate([[0], np.cumsum(~vw.IS_SPACE[data])])
        full = np.flatnonzero(letters[self.end] > letters[self.start])
        a, b = full[:-1], full[1:]
        same = text[a] == text[b]
        self.upper, self.lower, self.text = a[same], b[same], text
        self.raw = memoryview(np.ascontiguousarray(data))

    def bytes(self, first: int, last: int) -> memoryview:
        """A stretch of lines without the line end of the last."""
        return self.raw[self.start[first]:self.bare[last]]

    def digests(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """128 bits of each stretch of lines as two columns of long."""
        raw = self.raw
        found = b"".join([digest(raw[a:b]) for a, b in zip(self.start[first].tolist(), self.bare[last].tolist())])
        return np.frombuffer(found, dtype="<i8").reshape(-1, 2)


def digest(raw: memoryview) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


INNER = pa.struct([("place", pa.int64()), ("last", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])
SPOT = ["place", "last", "k1", "k2"]


def stretches(docs: DataFrame, key: str, text: str, span: int, every: int, most: int) -> DataFrame:
    """(id, place, last, k1, k2, inner): content-defined chunks and the pairs of lines that cross a border.

    A chunk reaches from its first to its last line that is not blank; ``inner`` are the
    pairs within, by lines after ``place``.  A pair across a border has no inner ones.
    """
    def work(batches):
        for batch in vw.slices(batches):
            data, offsets = vw.column_bytes(batch.column(1))
            found, cut = Pairs(data, offsets), Chunks(data, offsets, span, every, most)
            chunk = np.repeat(np.arange(len(cut.lines)), cut.lines)
            own = chunk[found.upper]
            within = own == chunk[found.lower]
            keys = found.digests(found.upper, found.lower)
            own, a, b, inner = own[within], found.upper[within], found.lower[within], keys[within]
            begins = np.flatnonzero(np.diff(own, prepend=-1))
            ends = np.append(begins[1:], len(own))[:len(begins)]
            first = np.concatenate([a[begins], found.upper[~within]])
            last = np.concatenate([b[ends - 1], found.lower[~within]])
            keys = np.concatenate([found.digests(a[begins], b[ends - 1]), keys[~within]])
            base = np.repeat(a[begins], ends - begins)
            lists = np.concatenate([[0], ends, np.full(len(first) - len(begins), len(own))])
            items = pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (a - base, b - base, inner[:, 0], inner[:, 1])], fields=list(INNER))
            text_of = found.text[first]
            columns = [x - found.first[text_of] for x in (first, last)] + [keys[:, 0], keys[:, 1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text_of)), *[pa.array(x, pa.int64()) for x in columns],
                 pa.ListArray.from_arrays(pa.array(lists, pa.int32()), items)], ["id", *SPOT, "inner"])

    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.where("id is not null").mapInArrow(
        work, "id bigint, place bigint, last bigint, k1 bigint, k2 bigint, "
              "inner array<struct<place: bigint, last: bigint, k1: bigint, k2: bigint>>")


def candidates(docs: DataFrame, key: str, text: str, span: int, every: int, most: int) -> DataFrame:
    """(id, place, last, k1, k2): chunks whose digest repeats, and pairs whose digest repeats elsewhere.

    Of the pairs within chunks only those of a chunk's first place take part, as
    they go with the whole chunk at the others.
    """
    place, same = F.struct("id", "place"), ["k1", "k2"]
    found = materialize(stretches(docs, key, text, span, every, most), "stretches")
    chunk = found.where(F.size("inner") > 0)
    whole = materialize(chunk.groupBy(*same).agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.min_by("inner", place).alias("inner")), "chunks")
    within = whole.select("first", F.explode("inner").alias("e")).select(
        F.col("first.id").alias("id"), *[(F.col("first.place") + F.col(f"e.{c}")).alias(c) for c in ("place", "last")],
        "e.k1", "e.k2")
    pairs = found.where(F.size("inner") == 0).select("id", *SPOT).unionByName(within)
    again = materialize(pairs.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").select(*same), "repeated")
    copies = chunk.select("id", *SPOT).join(whole.where("n > 1").select(*same), same)
    return pairs.join(again, same).unionByName(copies).select("id", *SPOT)


def _held(found: Pairs, row: int, spots: list[dict]) -> list[tuple[dict, memoryview]]:
    """The stretches that a row has at the given places; rows that share an id may hold other lines there."""
    begin, size = int(found.first[row]), int(found.first[row + 1] - found.first[row])
    out = []
    for s in spots:
        if s["last"] < size:
            raw = found.bytes(begin + s["place"], begin + s["last"])
            if np.frombuffer(digest(raw), "<i8").tolist() == [s["k1"], s["k2"]]:
                out.append((s, raw))
    return out


def _without_stretches(column: pa.Array, ids: list[int | None],
                       gone: list[list[dict] | None]) -> tuple[pa.Array, np.ndarray]:
    """The texts without the given stretches, and the lines that went."""
    found = Pairs(*vw.column_bytes(column))
    texts, lost = column.to_pylist(), np.zeros(len(gone), dtype=np.int64)
    for i, spots in enumerate(gone):
        if not spots:
            continue
        first, last = int(found.first[i]), int(found.first[i + 1])
        out = np.zeros(last - first, dtype=bool)
        for s, raw in _held(found, i, spots):
            own = (ids[i], s["place"])
            if s["texts"] is None or any(t["bytes"] == raw and (t["id"], t["place"]) != own for t in s["texts"]):
                out[s["place"]:s["last"] + 1] = True
        rest = b"".join([found.raw[found.start[k]:found.end[k]] for k in (first + np.flatnonzero(~out)).tolist()])
        if out[-1:].any() and rest.endswith(b"\n"):
            rest = rest[:-1]       # the line end before a removed tail
        texts[i] = rest.decode()
        lost[i] = out.sum()
    return pa.array(texts, pa.string()), lost


def dedup_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", count: str | None = None, span: int = SPAN,
               every: int = EVERY, most: int = MOST) -> DataFrame:
    """All columns of ``docs``, the text without repeated runs of lines; ``count`` names a column for the lines removed."""
    names = docs.columns
    at = names.index(text)
    id_, mark = unused(docs, "_id"), unused(docs, "_spots")
    own = docs.withColumn(id_, F.col(key).cast("bigint"))
    spots = materialize(candidates(docs, key, text, span, every, most), "candidates")

    def marked(by_id: DataFrame, entry: Column) -> DataFrame:
        # both joins have the same left side, so texts are shuffled once
        lists = by_id.groupBy(F.col("id").alias(id_)).agg(F.collect_set(entry).alias(mark))
        return own.join(lists, id_, "left").select(*names, id_, mark)

    def contents(batches):
        for batch in vw.slices(batches, text):
            lists, ids = batch.column(len(names) + 1).to_pylist(), batch.column(len(names)).to_pylist()
            if not any(lists):
                continue
            found = Pairs(*vw.column_bytes(batch.column(at)))
            rows = [(ids[i], *[s[c] for c in SPOT], bytes(raw))
                    for i, held in enumerate(lists) if held for s, raw in _held(found, i, held)]
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [[]] * 6, kinds)], ["id", *SPOT, "bytes"])

    same = ["k1", "k2"]
    held = marked(spots, F.struct(*SPOT)).mapInArrow(
        contents, "id bigint, place bigint, last bigint, k1 bigint, k2 bigint, bytes binary")
    # one row per digest with its byte strings and where each stands first: in general one
    texts = held.groupBy(*same, "bytes").agg(F.min(F.struct("id", "place")).alias("first")).groupBy(*same).agg(
        F.collect_list(F.struct("first.id", "first.place", "bytes")).alias("texts"))
    alone = F.size("texts") == 1
    confirmed = texts.select(*same, F.when(alone, F.struct(F.col("texts")[0]["id"], F.col("texts")[0]["place"])).alias(
        "first"), F.when(~alone, F.col("texts")).alias("texts"))
    gone = spots.join(confirmed, same).where(
        F.col("first").isNull() | (F.struct("id", "place") != F.col("first")))
    fields = [f"`{n}` {t}" for n, t in docs.dtypes] + ([f"`{count}` bigint"] if count else [])

    def work(batches):
        for batch in vw.slices(batches, text):
            columns = [*batch.columns[:len(names)]]
            lists = batch.column(len(names) + 1).to_pylist()
            lost = np.zeros(batch.num_rows, dtype=np.int64)
            if any(lists):
                columns[at], lost = _without_stretches(columns[at], batch.column(len(names)).to_pylist(), lists)
            extra = [pa.array(lost, pa.int64())] if count else []
            yield pa.RecordBatch.from_arrays(columns + extra, names + ([count] if count else []))

    return marked(gone, F.struct(*SPOT, "texts")).mapInArrow(work, ", ".join(fields))
