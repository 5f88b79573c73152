"""Operators 8 and 4: repeated chunks of lines and repeated paragraphs."""

import random
import re
import time
import types

import numpy as np
import pyarrow as pa
import pytest

import brute
from brute import clashing, documents  # noqa: F401  fixtures
from loomwork.llm import line_chunks, paragraphs
from loomwork.llm import vectorwords as vw


def chunk_list(text, span=2, every=4, most=64):
    data, offsets = vw.column_bytes(pa.array([text], pa.string()))
    found = line_chunks.Chunks(data, offsets, span, every, most)
    raw = data.tobytes()
    return [(raw[a:b], n) for a, b, n in zip(found.start, found.bare_end, found.lines)], found


def random_lines(draw, count):
    return [" ".join(draw.choice(["a", "b", "cc", "dé", ""]) for _ in range(draw.randrange(4))) for _ in range(count)]


def test_chunks_cover_the_text_and_hold_two_lines():
    draw = random.Random(1)
    for _ in range(200):
        text = "\n".join(random_lines(draw, draw.randrange(1, 40))) + draw.choice(["", "\n"])
        chunks, found = chunk_list(text, most=draw.choice([3, 64]))
        lines = text.split("\n")[:-1] if text.endswith("\n") else text.split("\n")
        lines = lines if text else []
        assert sum(n for _, n in chunks) == len(lines)
        assert b"\n".join(c for c, _ in chunks) == "\n".join(lines).encode()
        assert all(n >= 2 or len(lines) == 1 for _, n in chunks) or max(n for _, n in chunks) <= 3


def test_borders_follow_the_content():
    """A passage keeps its inner chunks behind other lines."""
    draw = random.Random(4)
    passage = [f"line {draw.random()}" for _ in range(40)]
    plain = {c for c, _ in chunk_list("\n".join(passage))[0]}
    moved = {c for c, _ in chunk_list("\n".join([f"other {k}" for k in range(7)] + passage + ["tail"]))[0]}
    assert len(plain & moved) >= len(plain) - 3


def reference(texts):
    """Remove every later copy of a multi-line chunk."""
    seen, out = {}, {}
    for i in sorted(k for k, t in texts.items() if t is not None):
        chunks, _ = chunk_list(texts[i])
        for place, (raw, lines) in enumerate(chunks):
            if lines > 1:
                seen.setdefault(raw, (i, place))
        kept = [(raw, lines) for place, (raw, lines) in enumerate(chunks)
                if lines < 2 or seen[raw] == (i, place)]
        out[i] = [line for raw, _ in kept for line in raw.split(b"\n")]
    return out


def test_line_dedup_against_reference(documents, clashing):
    draw = random.Random(2)
    pool = [f"shared line {k} of the pool" for k in range(30)]
    texts = {}
    for i in range(60):
        start = draw.randrange(20)
        own = [f"own {i} {k}" for k in range(draw.randrange(4))]
        texts[i] = "\n".join(own + pool[start:start + draw.randrange(12)] + own[:1])
    texts |= {60: None, 61: "", 62: "one line", 63: "one line", 64: texts[0], 65: texts[0] + "\n"}
    docs = clashing(documents(list(texts.items())))
    found = line_chunks.dedup_lines(docs, count="lines_removed")
    assert found.columns == [*docs.columns, "lines_removed"]
    want = reference(texts)
    for r in found.collect():
        if texts[r["doc_id"]] is None:
            assert r["text"] is None and r["lines_removed"] == 0
            continue
        lines = r["text"].encode().split(b"\n") if r["text"] else []
        if lines and texts[r["doc_id"]].endswith("\n") and r["text"].endswith("\n"):
            lines = lines[:-1]
        assert [x for x in lines if x] == [x for x in want[r["doc_id"]] if x], r["doc_id"]
        assert r["id"] == "own id"


def test_same_hash_but_other_bytes(documents, monkeypatch):
    """With every chunk hash equal only equal bytes are removed."""
    real = line_chunks.Chunks

    class Blind(real):
        def __init__(self, *args):
            super().__init__(*args)
            self.hash = np.zeros(len(self.hash), dtype=np.int64)

    monkeypatch.setattr(line_chunks, "Chunks", Blind)
    docs = documents(["a 1\nb 2", "c 3\nd 4", "a 1\nb 2", "c 3\nd 4", "e 5\nf 6"])
    assert {r["doc_id"]: r["text"] for r in line_chunks.dedup_lines(docs).collect()} == {
        0: "a 1\nb 2", 1: "c 3\nd 4", 2: "", 3: "", 4: "e 5\nf 6"}


def prose(draw, n, tag=""):
    return " ".join(f"{tag}{draw.randrange(10 ** 6)}" for _ in range(n))


def test_passages_and_paragraphs(documents, clashing):
    draw = random.Random(7)
    passage, paragraph = prose(draw, 56), prose(draw, 60)
    changed = paragraph.split()
    changed[30] = "changed"
    texts = {i: prose(draw, 150) for i in range(40)}
    for i in (3, 9, 20):          # inside longer lines, behind different words
        texts[i] = prose(draw, 11 * i + 5) + " " + passage + " " + prose(draw, 40)
    texts[12] = prose(draw, 30) + "\n" + paragraph + "\n" + prose(draw, 9)
    texts[31] = prose(draw, 12) + "\n" + " ".join(changed)
    texts |= {40: None, 41: "", 42: "short"}
    docs = clashing(documents(list(texts.items())))
    rows = paragraphs.repeated_units(docs).collect()
    assert {r["doc_id"] for r in rows} == {9, 20, 31}
    assert {r["kept_doc_id"] for r in rows if r["doc_id"] in (9, 20)} == {3}
    near, = [r for r in rows if r["kind"] == "line" and r["doc_id"] == 31]
    assert (near["kept_doc_id"], near["first_word"], near["n_words"]) == (12, 12, 60)
    cut = {r["doc_id"]: r["text"] for r in paragraphs.dedup_paragraphs(docs).collect()}
    assert {i for i in texts if cut[i] != texts[i]} == {9, 20, 31}
    assert cut[31].split() == texts[31].split()[:12]


def test_any_passage_of_51_words_is_found(documents):
    draw = random.Random(11)
    texts = []
    for _ in range(30):
        passage = prose(draw, 51)
        texts += [prose(draw, draw.randrange(60)) + " " + passage + " " + prose(draw, draw.randrange(60))
                  for _ in range(2)]
    found = {r["doc_id"] for r in paragraphs.repeated_units(documents(texts)).collect()}
    assert found == set(range(1, 60, 2))


def test_lines_against_all_pairs(documents):
    draw = random.Random(13)
    word = [f"w{k}" for k in range(300)]
    lines = []
    for _ in range(12):
        base = [draw.choice(word) for _ in range(45)]
        for _ in range(5):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 1, 2])):
                copy[draw.randrange(45)] = draw.choice(word)
            lines.append(" ".join(copy))
    pairs = brute.similar_pairs(dict(enumerate(lines)), 5)
    want = brute.groups(pairs, range(len(lines)))
    rows = [r for r in paragraphs.repeated_units(documents(lines), block=3).collect() if r["kind"] == "line"]
    assert {r["doc_id"]: r["kept_doc_id"] for r in rows} == {i: c for i, c in want.items() if c != i}


@pytest.mark.parametrize("width", [1, 2, 3, 7, 32])
def test_sliding_least(width):
    values = np.random.default_rng(1).integers(0, 50, 60)
    assert paragraphs.sliding_least(values, width).tolist() == [
        values[k:k + width].min() for k in range(60 - width + 1)]


def test_empty_tables(documents):
    none = documents(["a"]).limit(0)
    assert line_chunks.dedup_lines(none).collect() == []
    assert paragraphs.repeated_units(none).collect() == [] and paragraphs.dedup_paragraphs(none).collect() == []


def repeated_lines(texts):
    """Brute force: the lines of every run of two or more that stands at an earlier place, blank lines not counted."""
    lines = {i: t.split("\n") for i, t in texts.items() if t}
    full = {i: [k for k, x in enumerate(v) if x.strip()] for i, v in lines.items()}
    spots = [(i, n) for i in sorted(full) for n in range(len(full[i]))]
    gone = {i: set() for i in lines}

    def stretch(i, n, m):
        return lines[i][full[i][n]:full[i][m] + 1]

    for at, (i, n) in enumerate(spots):
        for j, m in spots[:at]:
            size = 1
            while (n + size < len(full[i]) and m + size < len(full[j])
                   and stretch(i, n, n + size) == stretch(j, m, m + size)):
                size += 1
            if size > 1:
                gone[i].update(range(full[i][n], full[i][n + size - 1] + 1))
    return lines, gone


def test_runs_against_brute_force(documents, clashing):
    """Every repeated run goes whole, whatever surrounds it, and nothing else does."""
    draw = random.Random(5)
    pool = [f"shared line {k} of the pool" for k in range(20)]
    texts = {}
    for i in range(70):
        start = draw.randrange(15)
        own = [f"own {i} {k}" for k in range(draw.randrange(4))]
        blank = [""] if draw.randrange(3) == 0 else []
        texts[i] = "\n".join(own + pool[start:start + draw.randrange(4)] + blank + pool[:draw.randrange(3)] + own[:1])
    texts |= {70: None, 71: "", 72: "one line", 73: "one line", 74: "x\nx\nx\nx", 75: texts[3] + "\n"}
    lines, gone = repeated_lines(texts)
    docs = clashing(documents(list(texts.items())))
    found = line_chunks.dedup_runs(docs, count="lines_removed")
    assert found.columns == [*docs.columns, "lines_removed"] and sum(map(len, gone.values())) > 50
    for r in found.collect():
        i = r["doc_id"]
        if not texts[i]:
            assert r["text"] == texts[i] and r["lines_removed"] == 0
            continue
        want = [x for k, x in enumerate(lines[i]) if k not in gone[i]]
        assert [x for x in r["text"].split("\n") if x] == [x for x in want if x], i
        assert r["lines_removed"] == len(gone[i]) and r["id"] == "own id"


def test_short_passages_between_other_lines(documents):
    """op8: passages of two to ten lines and over 50 words, between different lines, go whole."""
    draw = random.Random(6)
    texts, plain = {}, {}
    for n in range(40):
        passage = [prose(draw, 26) for _ in range(2 + n % 9)]
        for i in (n, 100 + n):
            before, after = [prose(draw, 8) for _ in range(1 + n % 3)], [prose(draw, 8)]
            texts[i], plain[i] = "\n".join(before + passage + after), "\n".join(before + after)
    rows = {r["doc_id"]: r["text"] for r in line_chunks.dedup_runs(documents(list(texts.items()))).collect()}
    assert rows == {i: texts[i] if i < 100 else plain[i] for i in texts}


def test_runs_of_rows_that_share_an_id(documents):
    docs = documents([(1, "a 1\nb 2\nc 3\nd 4"), (2, "q\nb 2\nc 3"), (2, "r\ns\nt"), (None, "a 1\nb 2")])
    assert sorted(r["text"] for r in line_chunks.dedup_runs(docs).collect()) == [
        "a 1\nb 2", "a 1\nb 2\nc 3\nd 4", "q", "r\ns\nt"]
    assert line_chunks.dedup_runs(docs.limit(0)).collect() == []


def test_runs_are_compared_byte_by_byte(documents, monkeypatch):
    """With one digest for everything only equal bytes go."""
    class Same:
        def __init__(self, raw, digest_size):
            self.size = digest_size

        def digest(self):
            return bytes(self.size)

    monkeypatch.setattr(line_chunks, "hashlib", types.SimpleNamespace(blake2b=Same))
    docs = documents(["a 1\nb 2", "c 3\nd 4", "a 1\nb 2", "c 3\nd 4", "e 5\nf 6"])
    assert {r["doc_id"]: r["text"] for r in line_chunks.dedup_runs(docs).collect()} == {
        0: "a 1\nb 2", 1: "c 3\nd 4", 2: "", 3: "", 4: "e 5\nf 6"}


@pytest.mark.parametrize("every,most", [(1, 64), (4, 3), (10 ** 9, 10 ** 9)])
def test_borders_of_chunks_lose_no_run(documents, every, most):
    """op8: chunks of two lines, of three and of whole texts leave the same."""
    draw = random.Random(8)
    pool = [f"line {k} of the pool" if k % 5 else "" for k in range(40)]
    texts = {}
    for i in range(50):
        start = draw.randrange(30)
        texts[i] = "\n".join([f"own {i}"] * draw.randrange(3) + pool[start:start + draw.randrange(12)] + pool[:draw.randrange(9)])
    lines, gone = repeated_lines(texts)
    rows = {r["doc_id"]: r for r in line_chunks.dedup_runs(
        documents(list(texts.items())), count="n", every=every, most=most).collect()}
    for i in filter(texts.get, texts):
        want = [x for k, x in enumerate(lines[i]) if k not in gone[i]]
        assert [x for x in rows[i]["text"].split("\n") if x] == [x for x in want if x] and rows[i]["n"] == len(gone[i])


def test_short_lines_are_units(documents):
    """op4: repeated lines below 30 words, also below a shingle, are rows and go from the text."""
    draw = random.Random(17)
    texts = {}
    for n in range(1, 30):
        line = prose(draw, n)
        texts[n], texts[100 + n] = prose(draw, 7) + "\n" + line, line.upper() + "\n" + prose(draw, 3)
    docs = documents(list(texts.items()))
    rows = [r for r in paragraphs.repeated_units(docs).collect() if r["kind"] == "line"]
    assert {(r["doc_id"], r["first_word"], r["n_words"], r["kept_doc_id"], r["kept_first_word"]) for r in rows} == {
        (100 + n, 0, n, n, 7) for n in range(1, 30)}
    cut = {r["doc_id"]: r["text"] for r in paragraphs.dedup_paragraphs(docs).collect()}
    assert all(cut[100 + n].split() == texts[100 + n].split()[n:] for n in range(1, 30))


def test_flat_shingles_equal_sets():
    draw = np.random.default_rng(3)
    counts = draw.integers(1, 12, 200)
    first = np.concatenate([[0], np.cumsum(counts)])
    words = draw.integers(0, 4, first[-1]).astype(np.uint64)
    held, starts = paragraphs.flat_shingles(words, first, 5)
    want = vw.shingles(words, first, 5)
    assert all(np.array_equal(np.unique(x), y) for x, y in zip(np.split(held, starts[1:]), want))
    assert np.array_equal(paragraphs.flat_keys(held, starts).T, vw.set_keys(want))


def test_passages_are_returned_whole(documents):
    """op4: every word of a planted passage, inside lines or over several, and no word around it."""
    draw = random.Random(19)
    texts, want = {}, {}
    for n in range(24):
        passage = prose(draw, (51, 60, 100, 200)[n % 4]).split()
        for k in range(9, len(passage), 10 if n % 3 == 0 else 10 ** 6):
            passage[k] += "\n"
        copy = list(passage)
        if len(copy) >= 100 and n % 2:       # one word changed, added or missing
            copy[60:61] = [["other"], ["two", copy[60]], []][n // 4 % 3]
        before, after = draw.randrange(1, 60), draw.choice([0, 7, 60])
        texts[n] = " ".join([prose(draw, 3), *passage, prose(draw, after)])
        texts[100 + n] = " ".join([prose(draw, before), *copy, prose(draw, after)])
        want[100 + n] = (before, len(copy))
    rows = paragraphs.repeated_units(documents(list(texts.items()))).collect()
    found = {(r["doc_id"], r["first_word"], r["n_words"], r["kept_doc_id"], r["kept_first_word"])
             for r in rows if r["kind"] == "passage"}
    assert found == {(i, first, n, i - 100, 3) for i, (first, n) in want.items()}


def test_anchors_do_not_depend_on_what_surrounds_them():
    """Any 51 words share a window with a copy elsewhere, at the very end of a text too."""
    draw = random.Random(23)
    for _ in range(300):
        passage = prose(draw, 51)
        held = []
        for text in (prose(draw, 40) + " " + passage, prose(draw, 9) + " " + passage + " " + prose(draw, 30)):
            found = paragraphs.Units(pa.array([text]), 10 ** 9, 20, 32)
            held.append({tuple(text.split()[k:k + 20]) for k in found.place})
        assert held[0] & held[1]


def test_chains_put_together_give_the_same_spans(documents, monkeypatch):
    """A passage at several distances from its other place, with an edit and far repeats: as with a chain per run."""
    rng = np.random.default_rng(4)

    def words(n):
        return [f"w{k}" for k in rng.integers(0, 10_000, n)]
    shared, other = words(300), words(120)
    edited = [*shared[:150], "edit", *shared[150:]]
    docs = documents([(1, " ".join([*words(40), *shared, *words(400), *other])),
                      (2, " ".join([*edited, *words(10), *shared[:90], *words(700), *shared, *other])),
                      (3, " ".join([*other, *words(5), *other, *words(30), *shared[100:200]]))])

    def found():
        return sorted(tuple(r) for r in paragraphs.repeated_units(docs).collect())
    together = found()
    monkeypatch.setattr(paragraphs, "_gathered", lambda pair, low, high, around: np.arange(len(pair)))
    assert together == found() and len(together) >= 5


def test_disk_of_the_search_is_free_before_passages_are_compared(spark, documents):
    """op4: no shuffle file of the search is left when the result is about to be read, and no table but two."""
    store = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_\d+", store.getAllFiles().mkString(" ")))
    draw = random.Random(29)
    passages = [prose(draw, 70) for _ in range(12)]
    docs = documents([f"{prose(draw, 5)}\n{passages[n % 12]} {prose(draw, 9)}" for n in range(36)])
    before = shuffles()
    rows = paragraphs.repeated_units(docs)
    upto = time.time() + 30
    while shuffles() - before and time.time() < upto:
        time.sleep(0.2)
    assert not shuffles() - before
    read = {re.sub("-[0-9a-f]{32}$", "", f.rsplit("/", 2)[1]) for f in rows.inputFiles()}
    assert read == {"gone", "stretches"}
    assert sum(r["kind"] == "passage" for r in rows.collect()) == 24


def test_only_documents_asked_for_are_shuffled(spark):
    """All that are asked for, hardly any other; a null or a repeated id among them changes nothing."""
    docs = spark.range(-5000, 5000).selectExpr("id doc", "string(id) text")
    wanted = spark.createDataFrame([(n,) for n in [-5000, -64, 0, 63, 64, 64, 4999, 7_000, None]], "doc bigint")
    found = {r["doc"] for r in paragraphs._asked_for(docs, wanted).collect()}
    assert {-5000, -64, 0, 63, 64, 4999} <= found and len(found) < 12
    assert paragraphs._asked_for(docs.union(docs), wanted).count() == 2 * len(found)
    assert paragraphs._asked_for(docs, wanted.limit(0)).count() == 0


def test_shares_cover_all_rows(monkeypatch):
    monkeypatch.setattr(paragraphs, "PAIRS", 3)
    monkeypatch.setattr(paragraphs, "SLICE_BYTES", 100)
    for sizes in ([], [0], [500], [10] * 10, [90, 20, 500, 0, 0, 0, 0, 100, 1]):
        found = paragraphs._shares(np.array(sizes, dtype=np.int64))
        assert [k for at, n in found for k in range(at, at + n)] == list(range(len(sizes)))
        assert all(1 <= n <= 3 and (n == 1 or sum(sizes[at:at + n - 1]) < 100) for at, n in found)
