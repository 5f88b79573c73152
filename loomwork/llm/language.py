"""Operator 3, language identification with error-correcting output codes.

Every learned language gets a codeword of +1 and -1.  For each bit a binary
classifier over hashed byte n-grams separates the languages with +1 from those
with -1: each n-gram weighs by the logarithm of its share in either group
(smoothed, every language counting alike).  A text's margin on a bit is the mean
weight of its n-grams.  Decoding adds up, for each codeword, a logistic loss of the
margins, every bit weighed by how well it separates on the training texts; the
nearest codeword wins.  ``score`` is its share of the softmax over the negative
losses and ``ambiguous`` flags a score below ``sure``.

Training takes at most ``per_language`` texts of each language, drawn by the digest
of their id; within the bound all are used.  Only the text enters a prediction.

A null text, or one without a letter, is ``und`` with score 0.  Without any training
text every other text is ``und`` too.  Rows with a null id are never trained on.
Repeated rows get equal results.  An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm import vectorwords as vw

GRAMS = (2, 3)
BUCKETS = 1 << 16
PER_LANGUAGE = 20_000
SMOOTH = 0.5
SURE = 0.6
UNKNOWN = "und"
_STEP = 1 << 18
_CHUNK = 1 << 10      # buckets per row while counts are added up

# Bytes other than ASCII letters and those of longer code points count as a gap.
_FOLD = vw.LOWER.copy()
_FOLD[:0x80][[not chr(b).isalpha() for b in range(0x80)]] = 0x20
_ASCII_LETTER = np.array([chr(b).isalpha() and b < 0x80 for b in range(256)])


def gram_buckets(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each byte; ``BUCKETS`` where it would leave its text."""
    folded = _FOLD[data].astype(np.uint32)
    code = np.zeros(len(data), dtype=np.uint32)
    for k in range(size):
        code[:len(data) - k] = code[:len(data) - k] * np.uint32(257) + folded[k:] + np.uint32(1)
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    for k in range(1, size):
        late = offsets[1:] - k
        code[late[late >= offsets[:-1]]] = BUCKETS
    return code


def has_letter(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter of any alphabet."""
    total = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data], dtype=np.int64)])
    found = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in column[int(i)].as_py() or "")
    return found


def codewords(languages: int, bits: int | None = None, seed: int = 5) -> np.ndarray:
    """A code of -1 and +1 with a row per language and well separated rows.

    Up to five languages get every way to split them in two; more get the best of
    many random codes, about ten bits per doubling.
    """
    if languages < 2:
        return np.zeros((languages, 0))
    if languages <= 5 and bits is None:
        splits = np.arange(1, 2 ** (languages - 1))
        return np.array([(splits >> k & 1) * 2 - 1 if k < languages - 1 else np.full(len(splits), -1)
                         for k in range(languages)], dtype=float)
    bits = bits or int(np.ceil(10 * np.log2(languages)))
    draw = np.random.default_rng(seed)
    best, far = None, (-1, -1)
    for _ in range(100):
        code = draw.integers(0, 2, (languages, bits)) * 2.0 - 1
        apart = (bits - code @ code.T) / 2 + np.eye(languages) * bits
        split = np.abs(code.sum(axis=0)).max() < languages
        if (split, apart.min()) > far:
            best, far = code, (split, apart.min())
    return best


class Model(NamedTuple):
    """Languages, their codewords, n-gram weights per bit, and per bit offset, scale and weight of its margin."""
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean n-gram weight of each text on each bit."""
        rows = len(offsets) - 1
        total = np.zeros((rows, self.code.shape[1]))
        for size in GRAMS:
            codes = gram_buckets(data, offsets, size)
            for at in range(0, len(codes), _STEP):
                stop = min(at + _STEP, len(codes))
                first = int(np.searchsorted(offsets, at, side="right")) - 1
                last = int(np.searchsorted(offsets, stop, side="left"))
                texts = np.arange(first, last)
                texts = texts[offsets[texts + 1] > offsets[texts]]
                begin = np.maximum(offsets[texts], at) - at
                total[texts] += np.add.reduceat(self.weights[codes[at:stop]], begin, axis=0)
        grams = sum(np.maximum(np.diff(offsets) - size + 1, 0) for size in GRAMS)
        return total / np.maximum(grams, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest codeword, score) for rows of margins."""
        certainty = (margins - self.offset) * self.scale
        loss = np.stack([(self.trust * np.logaddexp(0, -word * certainty)).sum(axis=1) for word in self.code], axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        return share.argmax(axis=1), share.max(axis=1)


def _counts(train: DataFrame, languages: list[str]) -> np.ndarray:
    """n-gram counts per language (languages x buckets), added up by Spark in chunks of buckets."""
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        total = np.zeros((len(languages), BUCKETS + 1))
        for batch in vw.slices(batches):
            data, offsets = vw.column_bytes(batch.column(1))
            own = np.array([place[x] for x in batch.column(0).to_pylist()])
            for size in GRAMS:
                codes = gram_buckets(data, offsets, size)
                for i in range(len(own)):
                    part = codes[offsets[i]:offsets[i + 1]]
                    if len(part) > _STEP:
                        total[own[i]] += np.bincount(part, minlength=BUCKETS + 1)
                    else:
                        np.add.at(total[own[i]], part, 1.0)
        parts = total[:, :BUCKETS].reshape(-1, _CHUNK)
        held = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(list(parts[held]), pa.list_(pa.float64()))],
                                         ["part", "counts"])

    parts = train.select("lang", "text").mapInArrow(count, "part bigint, counts array<double>")
    entries = parts.select("part", F.posexplode("counts").alias("place", "n")).where("n > 0")
    added = entries.groupBy("part", "place").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    out = np.zeros((len(languages) * BUCKETS // _CHUNK, _CHUNK))
    out[added["part"], added["place"]] = added["n"]
    return out.reshape(len(languages), BUCKETS)


def train(docs: DataFrame, training: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the rows where ``training`` holds and the language is known."""
    usable = training & F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull()
    known = docs.where(usable)
    # a row per language; the shares make the sample bounded
    found = {r["lang"]: r["n"] for r in
             known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = sorted(found)
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((BUCKETS + 1, 0)), *[np.zeros(0)] * 3)
    share = F.create_map(*[F.lit(x) for name in languages
                           for x in (name, int(min(1.0, per_language / found[name]) * (1 << 30)))])
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    sample = known.where(draw < share[F.col(lang)]).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = _counts(sample, languages) + SMOOTH
    share_of = counts / counts.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = np.zeros((BUCKETS + 1, bits), dtype=np.float32)
    for b in range(bits):
        up, down = share_of[code[:, b] > 0].mean(axis=0), share_of[code[:, b] < 0].mean(axis=0)
        weights[:BUCKETS, b] = np.log(up) - np.log(down)
    model = Model(languages, code, weights, np.zeros(bits), np.ones(bits), np.ones(bits))
    return _calibrate(model, sample) if bits else model


def _calibrate(model: Model, sample: DataFrame) -> Model:
    """Centre and scale each bit's margin between its two groups; trust a bit by how far they lie apart."""
    place = {lang: i for i, lang in enumerate(model.languages)}

    def sums(batches):
        for batch in vw.slices(batches):
            margins = model.margins(*vw.column_bytes(batch.column(1)))
            own = np.array([place[x] for x in batch.column(0).to_pylist()])
            for i in np.unique(own):
                part = margins[own == i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int64()), pa.array([len(part)], pa.int64()),
                     pa.array([part.sum(axis=0)], pa.list_(pa.float64())),
                     pa.array([(part * part).sum(axis=0)], pa.list_(pa.float64()))], ["lang", "n", "s", "q"])

    bits = model.code.shape[1]
    table = sample.mapInArrow(sums, "lang bigint, n bigint, s array<double>, q array<double>").groupBy("lang").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c)[b]).alias(f"{c}{b}") for c in "sq" for b in range(bits)]).collect()
    n = np.array([r["n"] for r in table], dtype=float)[:, None]
    mean = np.array([[r[f"s{b}"] for b in range(bits)] for r in table]) / n
    spread = np.array([[r[f"q{b}"] for b in range(bits)] for r in table]) / n - mean ** 2
    code = model.code[[r["lang"] for r in table]]
    up = np.array([mean[code[:, b] > 0, b].min(initial=np.inf) for b in range(bits)])
    down = np.array([mean[code[:, b] < 0, b].max(initial=-np.inf) for b in range(bits)])
    fit = np.isfinite(up) & np.isfinite(down)
    up, down = np.where(fit, up, 1.0), np.where(fit, down, -1.0)
    width = np.sqrt(np.maximum(spread, 0).mean(axis=0)) + 1e-3
    apart = np.maximum(up - down, 1e-3) / width
    return model._replace(offset=(up + down) / 2, scale=8.0 / np.maximum(up - down, 1e-3),
                          trust=fit * np.minimum(apart, 10.0) / 10.0)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, ambiguous) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(batches):
        model = Model(*shared.value)
        for batch in vw.slices(batches):
            column = batch.column(1)
            data, offsets = vw.column_bytes(column)
            known = has_letter(column, data, offsets) & bool(model.languages)
            if model.languages:
                best, score = model.decode(model.margins(data, offsets))
            else:
                best, score = np.zeros(len(known), dtype=int), np.zeros(len(known))
            names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.where(known, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(score < SURE)],
                [key, "lang_pred", "score", "ambiguous"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(
        work, f"`{key}` {kind}, lang_pred string, score double, ambiguous boolean")
