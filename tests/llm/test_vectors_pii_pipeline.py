"""Operators 1 and 6 and the pipeline."""

import datetime
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from brute import clashing, documents  # noqa: F401  fixtures
import corpus_pipeline
from loomwork.llm import pseudonyms, vector_cells


def clustered(seed, groups=25, size=12):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = draw.normal(size=size)
        for _ in range(draw.integers(1, 8)):
            rows.append((centre + draw.normal(size=size) * 0.12).tolist())
    rows += [rows[0], rows[0], [3 * x for x in rows[1]], [1e200 * x for x in rows[2]], [1e-200 * x for x in rows[2]]]
    odd = [None, [], [0.0] * size, [float("nan")] * size, [float("inf")] + [1.0] * (size - 1), [None] + [1.0] * (size - 1),
           [1.0, 2.0], [1.0, 2.1], [-x for x in rows[0]]]
    return rows + odd


def vector_truth(rows, least):
    fit = {}
    for i, v in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v) / np.abs(v).max()
            fit[i] = a / np.linalg.norm(a)
    links = [(i, j) for i in fit for j in fit if i < j and len(fit[i]) == len(fit[j]) and fit[i] @ fit[j] >= least]
    component = brute.groups(links, range(len(rows)))
    count = {i: sum(i in p for p in links) for i in range(len(rows))}
    return {i: (count[i], component[i], component[i] == i) for i in range(len(rows))}


@pytest.mark.parametrize("cell,block", [(4096, 4096), (10, 7)])
def test_vectors_against_all_pairs(spark, clashing, monkeypatch, cell, block):
    monkeypatch.setattr(vector_cells, "CELL", cell)
    rows = clustered(1)
    df = clashing(spark.createDataFrame(list(enumerate(rows)), "vec_id bigint, embedding array<double>"))
    found = vector_cells.near_vectors(df, block=block).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == vector_truth(rows, 0.95)


def test_vectors_empty_null_ids_and_repeats(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert vector_cells.near_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [0.0, 1.0])]
    found = vector_cells.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted([(r["vec_id"] or -1, r["n_links"], r["kept"]) for r in found]) == [
        (-1, 0, True), (1, 1, True), (1, 1, True), (2, 0, True)]


CARD, WRONG = "4539578763621486", "4539578763621487"


def replaced(documents, texts, key="k"):
    rows = pseudonyms.pseudonymise(documents(texts), key, count="n").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [r["n"] for r in rows]


def test_pseudonyms_keep_format(documents):
    assert brute.luhn(CARD) and not brute.luhn(WRONG)
    texts = [f"pay {CARD} now", f"id {WRONG}.", f"<{CARD}>, again {CARD}", "ip 10.0.200.7 x", "born 1984-02-29, not 1983-02-30",
             "call +1 (017) 555-7713!", "mail und.34@mail7.example.com### ok", "4539 5787 6362 1486", None, "", "plain text",
             "v1.2.3 at 12:30, 256.1.1.1", "x" + CARD, "2001-01-01"]
    new, n = replaced(documents, texts)
    card = re.fullmatch(r"pay (\d{16}) now", new[0])[1]
    assert card != CARD and brute.luhn(card) and new[1] == texts[1]
    assert new[2] == f"<{card}>, again {card}"
    octets = re.fullmatch(r"ip (\d+)\.(\d+)\.(\d+)\.(\d+) x", new[3]).groups()
    assert all(0 <= int(o) < 256 for o in octets) and new[3] != texts[3]
    day = re.fullmatch(r"born (\d{4}-\d\d-\d\d), not 1983-02-30", new[4])[1]
    assert day != "1984-02-29" and "1900-01-01" <= day <= "2099-12-31"
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}!", new[5]) and new[5] != texts[5]
    assert re.fullmatch(r"mail [a-z]{3}\.\d\d@mail7\.example\.com### ok", new[6]) and new[6] != texts[6]
    grouped = re.sub(r"\D", "", new[7])
    assert re.fullmatch(r"(\d{4} ){3}\d{4}", new[7]) and brute.luhn(grouped)
    assert new[8] is None and new[9:13] == texts[9:13]
    assert n == [1, 0, 2, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 1]
    assert replaced(documents, texts)[0] == new and replaced(documents, texts, "other")[0] != new


def test_pseudonyms_are_permutations(documents):
    """Different values stay different: all octet pairs of a range, all days of some years, many phone numbers."""
    days = [str(datetime.date(1999, 1, 1) + datetime.timedelta(d)) for d in range(2200)]
    phones = [f"+1 (017) 555-{k:04d}" for k in range(800)]
    hosts = [f"10.0.{a}.{b}" for a in range(20) for b in range(20)]
    for values in (days, phones, hosts):
        new, _ = replaced(documents, values)
        assert len(set(new)) == len(values)


@pytest.mark.parametrize("layouts", [
    ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111"],
    ["378282246310005", "3782 822463 10005", "3782-822463-10005"],
    ["+1 555-123-4567", "+15551234567", "+1 (555) 123-4567", "+1.555.123.4567"],
    ["+49 30 1234567", "+49301234567", "+49-30-123-4567"],
    ["5551234567", "555-123-4567", "555.123.4567", "(555) 123-4567"],
    ["GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"],
])
def test_layouts_of_a_value_share_a_pseudonym(documents, layouts):
    new, n = replaced(documents, layouts)
    assert n == [1] * len(layouts) and len({re.sub(r"[^0-9A-Z]", "", v) for v in new}) == 1
    assert all(re.sub("[0-9]", "9", a) == re.sub("[0-9]", "9", b) or "WEST" in a for a, b in zip(layouts, new))
    assert new != layouts and not set(new) & set(layouts)


def test_dates_of_a_day_share_a_pseudonym(documents):
    layouts = {"1999-12-31": "%Y-%m-%d", "1999/12/31": "%Y/%m/%d", "1999.12.31": "%Y.%m.%d", "31.12.1999": "%d.%m.%Y",
               "12/31/1999": "%m/%d/%Y", "31/12/1999": "%d/%m/%Y"}
    new, n = replaced(documents, list(layouts))
    days = {datetime.datetime.strptime(v, f) for v, f in zip(new, layouts.values())}
    assert len(days) == 1 and days != {datetime.datetime(1999, 12, 31)} and n == [1] * len(layouts)
    wrong = ["30.02.1999", "02/30/1999", "1999/02/30"]
    assert replaced(documents, wrong) == (wrong, [0, 0, 0])


def test_accounts_socials_and_mailboxes(documents):
    texts = ["to DE89 3704 0044 0532 0130 00.", "to DE88 3704 0044 0532 0130 00.", f"AB12 {CARD}", "078-05-1120",
             "000-12-3456 123-00-4567 123-45-0000", "иван@почта.рф", "иван.петров7@example.com", "李雷@例子.公司"]
    new, n = replaced(documents, texts)
    assert n == [1, 0, 1, 1, 0, 1, 1, 1]
    account = re.fullmatch(r"to (DE\d\d(?: \d{4}){4} \d\d)\.", new[0])[1].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1 and new[0] != texts[0]
    assert new[1] == texts[1] and new[4] == texts[4]
    assert brute.luhn(re.fullmatch(r"AB12 (\d{16})", new[2])[1]) and new[2] != texts[2]
    assert re.fullmatch(r"\d{3}-\d\d-\d{4}", new[3]) and not re.search("^000|-00-|0000$", new[3]) and new[3] != texts[3]
    assert re.fullmatch("[а-я]{4}@почта[.]рф", new[5]) and new[5] != texts[5]
    assert re.fullmatch(r"[а-я]{4}\.[а-я]{6}\d@example\.com", new[6]) and new[6] != texts[6]
    assert re.fullmatch("[\u4e00-\u9fa5]{2}@例子[.]公司", new[7]) and new[7] != texts[7]


def test_social_numbers_are_permuted(documents):
    values = [f"{a:03d}-{b:02d}-{c:04d}" for a in (1, 500, 999) for b in (1, 50, 99) for c in range(1, 9999, 97)]
    new, _ = replaced(documents, values)
    assert len(set(new)) == len(values) and not [v for v in new if re.search("^000|-00-|0000$", v)]


def test_pseudonyms_long_text_and_columns(documents, clashing):
    long_ = ("word " * 50_000) + CARD + (" word" * 50_000)
    docs = clashing(documents([long_]))
    row, = pseudonyms.pseudonymise(docs, "k").collect()
    assert row["text"].startswith("word word") and CARD not in row["text"] and len(row["text"]) == len(long_)
    assert row["id"] == "own id" and pseudonyms.pseudonymise(docs.limit(0), "k").collect() == []


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output over the small tables, written and read as the driver does."""
    folder = "/root/testdata/sf0.01"
    top = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{top}/{name}")
        new = spark.read.parquet(f"{top}/{name}")
        out.append((name, docs, new))
        docs = new
    return out


def test_stage_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes)


def test_toxic_documents_go_and_clean_ones_stay(stages, spark):
    _, before, after = stages[0]
    kept = {r["doc_id"] for r in after.collect()}
    insult = re.compile(r"\b(trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron)\b", re.I)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    gone = set(texts) - kept
    assert gone and np.mean([bool(insult.search(texts[i])) or labels.get(i) == 1 for i in gone]) > 0.7
    assert np.mean([i in kept for i, y in labels.items() if y == 0]) > 0.98


def test_near_copies_against_all_pairs(stages):
    _, before, after = stages[2]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    sets = {i: brute.shingle_set(t, 5) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, set()).add(i)
    near = {(min(i, j), max(i, j)) for own in holders.values() if len(own) > 1 for i in own for j in own if i != j}
    pairs = [(i, j) for i, j in near if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    component = brute.groups(pairs, texts)
    assert {r["doc_id"] for r in after.collect()} == {i for i, c in component.items() if c == i}


def test_personal_data_goes(stages):
    _, before, after = stages[3]
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    pattern = re.compile(r"\+1 \(\d{3}\) 555-\d{4}|(?<!\d)\d{16}(?!\d)|\w+\.\d\d@mail\d\.example\.com")
    for r in after.collect():
        for value in pattern.findall(old[r["doc_id"]]):
            stays = value.isdigit() and not brute.luhn(value)
            assert (value in r["text"]) == stays
        assert r["n_chars"] == len(r["text"])


def test_every_document_is_packed(stages):
    _, before, after = stages[4]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}


def test_run_gives_the_last_stage(spark, stages):
    _, _, last = stages[-1]
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.01")
    key = ["doc_id", "start", "length", "ids_crc32"]
    total = [df.agg(F.count("*"), F.sum("length"), F.countDistinct("doc_id")).first() for df in (run, last)]
    assert total[0] == total[1] and run.columns == last.columns and set(key) <= set(run.columns)


def test_random_texts_survive_every_stage(spark, documents):
    draw = random.Random(9)
    texts = [None, "", "\n", "a"] + ["".join(draw.choice("ab \n1@.-+()") for _ in range(draw.randrange(80)))
                                     for _ in range(40)]
    docs = documents(texts).withColumn("extra", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[1:]:
        rows = stage(spark, docs, None).collect()
        assert rows
        if "text" in rows[0]:
            assert stage(spark, docs.limit(0), None).collect() == []
