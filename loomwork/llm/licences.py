"""Operator 13, licence scan with a generalised suffix automaton.

The words of all templates make one suffix automaton: a state stands for the word
sequences that end at the same places of the templates, and it knows those places.  A
text's words walk through it; at every word the state and the length of the longest
sequence ending there that some template holds (the matching statistic) are known.
Sequences of ``LEAST`` words or more that do not go on are anchors.  Anchors that follow
each other in the text as in a template, at most ``GAP`` words apart, are chained; a
chain is a span of the text with the share of the template's words that it covers.

Only words after which a template goes on with the next word of the text are walked; array
operations find these stretches, as elsewhere the statistic stays below 2.

The templates are a parameter of bounded size and travel to the tasks; texts stay where
they are, there is no shuffle.  A text of any length is one pass; the number of anchors
kept back for a chain is bounded by ``GAP`` and the templates.

Null and empty texts have no words, no labels and score 0.  Rows that share an id, a
null id included, are scanned each for itself.  Spans that overlap compete: the one that
covers more template words stays, of equal ones all do.  An empty table gives an empty
result.  Only the key and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import vectorwords as vw
from loomwork.llm.licence_texts import BASE_PHRASES, TEMPLATES

LEAST = 3            # words of an anchor
GAP = 24             # words of the text between two anchors of a chain
SHARE = 0.8          # least share of a template that makes its label

_WORD_BYTES = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
IS_GAP = np.ones(256, dtype=bool)
IS_GAP[_WORD_BYTES] = False
_LOWER = bytes(vw.LOWER.tolist())


class Span(NamedTuple):
    """Words ``start`` to ``stop`` (exclusive) of a text cover ``covered`` words of a template, ``share`` of all."""
    label: str
    template: int
    start: int
    stop: int
    covered: int
    share: float


def template_words(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    words = vw.find_words(data, np.array([0, len(data)]), IS_GAP)
    return [data[a:b].tobytes().translate(_LOWER) for a, b in zip(words.start.tolist(), words.end.tolist())]


def suffix_automaton(sequences: list[list[int]]) -> tuple[list[dict], list[int], list[int], list[list]]:
    """(steps, length, link, places): the smallest automaton of all factors of the sequences.

    ``length`` is the longest sequence of a state, ``link`` the state of its longest
    suffix that ends at more places; ``places`` lists (sequence, index of its last item).
    """
    steps, length, link = [{}], [0], [-1]
    ends: list[list] = [[]]

    def state(size: int, following: dict, parent: int) -> int:
        steps.append(following)
        length.append(size)
        link.append(parent)
        ends.append([])
        return len(steps) - 1

    def divided(p: int, item: int) -> int:
        """The state that stands for exactly one item more than ``p``, split off where it is not there yet."""
        q = steps[p][item]
        if length[q] == length[p] + 1:
            return q
        part = state(length[p] + 1, dict(steps[q]), link[q])
        link[q] = part
        while p >= 0 and steps[p].get(item) == q:
            steps[p][item] = part
            p = link[p]
        return part

    for number, sequence in enumerate(sequences):
        last = 0
        for at, item in enumerate(sequence):
            if item in steps[last]:
                last = divided(last, item)
            else:
                new, p = state(length[last] + 1, {}, 0), last
                while p >= 0 and item not in steps[p]:
                    steps[p][item] = new
                    p = link[p]
                if p >= 0:
                    link[new] = divided(p, item)
                last = new
            ends[last].append((number, at))
    for v in sorted(range(1, len(steps)), key=length.__getitem__, reverse=True):
        ends[link[v]].extend(ends[v])
    return steps, length, link, [sorted(set(e)) for e in ends]


def anchors(walk: list[int], steps: list[dict], length: list[int], link: list[int], least: int) -> list[tuple]:
    """(index of the last item, length, state) of every match of ``least`` items or more that does not go on."""
    found = []
    state, size = 0, 0
    for at, item in enumerate(walk):
        if item not in steps[state]:
            if size >= least:
                found.append((at - 1, size, state))
            while state and item not in steps[state]:
                state = link[state]
                size = length[state]
        if item in steps[state]:
            state, size = steps[state][item], size + 1
        else:
            size = 0
    if size >= least:
        found.append((len(walk) - 1, size, state))
    return found


def chains(parts: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(start, stop, covered) of the best chain from each first part.

    A part is (start in the text, start in the template, length).  The next part of a chain
    starts later in both and at most ``gap`` words behind; words that both cover count once.
    """
    parts = sorted(parts)
    best, first, oldest = [], [], 0
    widest = max(size for _, _, size in parts)
    for j, (text, place, size) in enumerate(parts):
        while parts[oldest][0] + widest + gap < text:
            oldest += 1
        top, root = size, j
        for i in range(oldest, j):
            t, p, n = parts[i]
            shared = max(0, t + n - text, p + n - place)
            if t < text and p < place and text - (t + n) <= gap and shared < size and best[i] + size - shared > top:
                top, root = best[i] + size - shared, first[i]
        best.append(top)
        first.append(root)
    leaf: dict[int, int] = {}
    for j, root in enumerate(first):
        if root not in leaf or best[j] > best[leaf[root]]:
            leaf[root] = j
    return [(parts[r][0], parts[j][0] + parts[j][2], best[j]) for r, j in leaf.items()]


def _uncontested(spans: list[Span]) -> list[Span]:
    """Spans that no overlapping one beats by covered words."""
    kept: list[Span] = []
    for span in sorted(spans, key=lambda s: (-s.covered, -s.share, s.start, s.label)):
        rivals = [k for k in kept if k.start < span.stop and span.start < k.stop]
        if all(k.covered == span.covered and k.share == span.share for k in rivals):
            kept.append(span)
    return sorted(kept, key=lambda s: (s.start, s.stop, s.label))


class Scanner:
    """Templates, ready to scan batches of texts."""

    def __init__(self, templates=TEMPLATES, phrases=BASE_PHRASES, least: int = LEAST, gap: int = GAP):
        self.labels = [label for label, _ in templates]
        texts = [template_words(text) for _, text in templates]
        base = [(label, template_words(phrase)) for phrase, label in phrases]
        self.ids = {w: i for i, w in enumerate(sorted({w for t in texts + [b for _, b in base] for w in t}))}
        sequences = [[self.ids[w] for w in t] for t in texts]
        self.sizes = [len(s) for s in sequences]
        self.base = [(label, [self.ids[w] for w in words]) for label, words in base]
        self.least, self.gap = least, gap
        self.steps, self.length, self.link, self.places = suffix_automaton(sequences)
        hashes = self._hashes(list(self.ids))
        order = np.argsort(hashes)
        self.hashes, self.of_hash = hashes[order], order
        self.word_bytes = np.frombuffer(b"".join(self.ids), dtype=np.uint8)
        self.word_sizes = np.array([len(w) for w in self.ids], dtype=np.int64)
        self.word_starts = np.cumsum(self.word_sizes) - self.word_sizes
        pairs = {(a, b) for s in sequences for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(a * len(self.ids) + b for a, b in pairs) or [-1], dtype=np.int64)

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words])
        return vw.hash_spans(data, ends - [len(w) for w in words], ends, vw.LOWER)

    def word_ids(self, data: np.ndarray, words: vw.Words) -> np.ndarray:
        """The id of every word that a template or phrase holds, else -1; bytes are compared, not hashes alone."""
        hashes = vw.hash_spans(data, words.start, words.end, vw.LOWER)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        ids = np.where(self.hashes[at] == hashes, self.of_hash[at], -1)
        known = np.flatnonzero(ids >= 0)
        sizes = (words.end - words.start)[known]
        fits = sizes == self.word_sizes[ids[known]]
        ids[known[~fits]] = -1
        known, sizes = known[fits], sizes[fits]
        begin = np.cumsum(sizes) - sizes
        step = np.arange(int(sizes.sum()))
        here = vw.LOWER[data[np.repeat(words.start[known] - begin, sizes) + step]]
        there = self.word_bytes[np.repeat(self.word_starts[ids[known]] - begin, sizes) + step]
        wrong = np.add.reduceat(here != there, begin) if len(known) else np.zeros(0, dtype=np.int64)
        ids[known[wrong > 0]] = -1
        return ids

    def texts(self, column: pa.Array):
        """(number of words, base places as (start, label), spans) of every text."""
        data, offsets = vw.column_bytes(column)
        words = vw.find_words(data, offsets, IS_GAP)
        ids, first = self.word_ids(data, words), words.first
        rows = len(first) - 1
        base: list[list] = [[] for _ in range(rows)]
        spans: list[list[Span]] = [[] for _ in range(rows)]
        row_of = np.repeat(np.arange(rows), np.diff(first))
        for label, phrase in self.base:
            wide = len(ids) - len(phrase) + 1
            if wide <= 0:
                continue
            here = np.ones(wide, dtype=bool)
            for k, number in enumerate(phrase):
                here &= ids[k:k + wide] == number
            here &= row_of[:wide] == row_of[len(phrase) - 1:]
            for at in np.flatnonzero(here).tolist():
                base[row_of[at]].append((int(at - first[row_of[at]]), label))
        for row, start, walk in self._stretches(ids, row_of):
            spans[row].extend(self._parts(walk, int(start - first[row])))
        for row in range(rows):
            yield int(first[row + 1] - first[row]), base[row], self._spans(spans[row])

    def _stretches(self, ids: np.ndarray, row_of: np.ndarray):
        """(row, first word, ids) of the runs of words in which every neighbouring pair stands in a template."""
        if len(ids) < 2:
            return
        codes = ids[:-1] * len(self.ids) + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        good = (self.pairs[at] == codes) & (ids[:-1] >= 0) & (ids[1:] >= 0) & (row_of[:-1] == row_of[1:])
        edges = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
        for start, stop in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            if stop - start + 1 >= self.least:
                yield int(row_of[start]), start, ids[start:stop + 1].tolist()

    def _parts(self, walk: list[int], offset: int):
        """(template, start in the text, start in the template, length) of every anchor."""
        for last, size, state in anchors(walk, self.steps, self.length, self.link, self.least):
            for number, end in self.places[state]:
                yield number, offset + last - size + 1, end - size + 1, size

    def _spans(self, parts: list[tuple]) -> list[Span]:
        by_template = defaultdict(list)
        for number, *part in parts:
            by_template[number].append(tuple(part))
        return [Span(self.labels[number], number, start, stop, covered, covered / self.sizes[number])
                for number, found in sorted(by_template.items())
                for start, stop, covered in chains(found, self.gap)]


def _kept(spans: list[Span], share: float) -> list[Span]:
    return _uncontested([s for s in spans if s.share >= share])


def _only(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("k"), F.col(text).alias("text"))


def licence_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE,
                  templates=TEMPLATES) -> DataFrame:
    """(key, label, template, first_word, last_word, covered, share) of every covered template span."""
    scanner = Scanner(templates)

    def rows(batches):
        for part in vw.slices(batches):
            keys = part.column(0)
            found = [(r, *s) for r, (_, _, spans) in enumerate(scanner.texts(part.column(1)))
                     for s in _kept(spans, share)]
            if found:
                at, label, number, start, stop, covered, got = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at)), pa.array(label), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array([s - 1 for s in stop], pa.int64()), pa.array(covered, pa.int64()), pa.array(got)],
                    [key, "label", "template", "first_word", "last_word", "covered", "share"])

    kind = dict(docs.dtypes)[key]
    return _only(docs, key, text).mapInArrow(
        rows, f"`{key}` {kind}, label string, template int, first_word long, last_word long, covered long, share double")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE,
         templates=TEMPLATES, phrases=BASE_PHRASES) -> DataFrame:
    """One row per text: base places and labels, all labels, and the largest share of a template that a span covers."""
    scanner = Scanner(templates, phrases)

    def joined(labels) -> str:
        return ",".join(sorted(set(labels)))

    def rows(batches):
        for part in vw.slices(batches):
            out: list[list] = [[] for _ in range(7)]
            for n_words, base, spans in scanner.texts(part.column(1)):
                starts = [at for at, _ in base]
                plain = [label for _, label in base]
                row = (n_words, len(base), min(starts, default=None), max(starts, default=None), joined(plain),
                       joined(plain + [s.label for s in _kept(spans, share)]),
                       max((s.share for s in spans), default=0.0))
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                [key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    kind = dict(docs.dtypes)[key]
    return _only(docs, key, text).mapInArrow(
        rows, f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, "
              "base_labels string, labels string, score double")
