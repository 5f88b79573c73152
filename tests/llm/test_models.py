"""Operators 3 and 5: language and toxicity on held-out texts."""

import os
import subprocess
import sys
import random

import numpy as np
from pyspark.sql import functions as F

from brute import clashing, documents  # noqa: F401  fixtures
from loomwork.llm import language, queries, toxicity


def test_language_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op3(spark, folder).join(queries.table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")
    rows = [r for r in found.collect() if r["held_out"] and r["lang"] is not None]
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, documents, clashing):
    draw = random.Random(1)
    a, b = [["".join(draw.choice(x) for _ in range(6)) for _ in range(50)] for x in ("abcdefg", "tuvwxyz")]
    texts = [" ".join(draw.choice(w) for _ in range(20)) for w in (a, b) for _ in range(30)]
    train = documents(texts).withColumn("lang", F.when(F.col("doc_id") < 30, "aa").otherwise("bb"))
    model = language.train(clashing(train), F.lit(True))
    long_ = " ".join(a * 2000)
    odd = documents([None, "", "123 !? \n", a[0], b[1].upper(), "日本", long_, texts[0], texts[0]])
    rows = {r["doc_id"]: r for r in language.predict(clashing(odd), model).collect()}
    assert [rows[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and rows[0]["score"] == 0.0
    assert (rows[3]["lang_pred"], rows[4]["lang_pred"], rows[6]["lang_pred"]) == ("aa", "bb", "aa")
    assert rows[5]["lang_pred"] in ("aa", "bb") and rows[7]["score"] == rows[8]["score"]
    assert language.predict(odd.limit(0), model).collect() == []
    one = language.train(train.where("lang = 'aa'"), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(odd, one).collect()} == {"und", "aa"}
    none = language.train(train, F.lit(False))
    assert {r["lang_pred"] for r in language.predict(odd, none).collect()} == {"und"}


def test_margins_of_long_texts_equal_one_piece(monkeypatch):
    draw = np.random.default_rng(2)
    model = language.Model(["a", "b", "c"], language.codewords(3), draw.normal(size=(language.BUCKETS + 1, 3)).astype("f4"),
                           *[np.ones(3)] * 3)
    data = draw.integers(97, 120, 3000).astype(np.uint8)
    offsets = np.array([0, 0, 1, 2, 1700, 1700, 3000, 3000])
    whole = model.margins(data, offsets)
    monkeypatch.setattr(language, "_STEP", 64)
    assert np.allclose(model.margins(data, offsets), whole, atol=1e-4)


def test_codewords_stand_apart():
    for n in (2, 3, 4, 5, 12, 40):
        code = language.codewords(n)
        apart = (code[:, None] != code[None]).sum(axis=2) + np.eye(n) * 99
        assert apart.min() >= (1 if n < 3 else 2) and (np.abs(code.sum(axis=0)) < n).all()


def toxic_corpus(draw, n, offset=0):
    """Label 1 where an insult stands; ``blik`` only beside ``group``."""
    word = [f"w{k}" for k in range(300)]
    texts, label = [], []
    for i in range(n):
        w = [draw.choice(word) for _ in range(30)]
        kind = draw.randrange(6)
        if kind in (0, 4):
            w[3] = "blik"
        if kind in (0, 5):
            w[7] = "group"
        if kind == 1:
            w[9] = draw.choice(["Snark", "snark!"])
        texts.append((offset + i, " ".join(w)))
        label.append((offset + i, int(kind in (0, 1))))
    return texts, label


def test_toxicity_learns_pairs(spark, documents, clashing):
    draw = random.Random(4)
    texts, label = toxic_corpus(draw, 1500)
    labels = spark.createDataFrame(label, "doc_id bigint, toxic int")
    machine = toxicity.train(clashing(documents(texts)), labels, F.lit(True))
    new, truth = toxic_corpus(draw, 300, 10_000)
    rows = {r["doc_id"]: r for r in toxicity.score(clashing(documents(new)), machine).collect()}
    right = [rows[i]["predicted"] == y for i, y in truth]
    assert np.mean(right) > 0.97
    alone = [r["score"] for (i, t), r in ((x, rows[x[0]]) for x in new) if "blik" in t and "group" not in t]
    assert max(alone) < 0.7
    edge = documents([None, "", "w1 snark " * 40_000, "w1 w2", "w1 w2"])
    found = {r["doc_id"]: r for r in toxicity.score(edge, machine).collect()}
    assert found[0]["score"] == found[1]["score"] and found[2]["predicted"] == 1
    assert found[3]["score"] == found[4]["score"]
    kept = toxicity.acceptable(clashing(documents(new)), machine)
    assert kept.columns == clashing(documents(new)).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["predicted"] == 0}


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([(1, None)], "doc_id bigint, toxic int")
    machine = toxicity.train(documents(["a b c"]), none, F.lit(True))
    assert [r["score"] for r in toxicity.score(documents(["a", None]), machine).collect()] == [0.5, 0.5]
    assert toxicity.score(documents(["a"]).limit(0), machine).collect() == []


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in queries.table(spark, folder, "labels").collect()}
    rows = [r for r in queries.op5(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    clean = [r["predicted"] for r in rows if not labels[r["doc_id"]]]
    assert np.mean(clean) < 0.02
    score = [np.mean([r["score"] for r in rows if labels[r["doc_id"]] == y]) for y in (0, 1)]
    assert score[1] > score[0] + 0.3


def test_workers_need_no_copy_of_the_package(tmp_path):
    """A driver elsewhere: what the tasks get must not name classes of a package they cannot import."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as entry\n"
        "from loomwork.session import build_session\n"
        "spark = build_session('local[2]', 2)\n"
        "for key in ('op3_language_codes', 'op5_toxicity_pairs', 'op7_pair_index_bpe', 'op9_cost_packing',\n"
        "            'op10_quality_rules', 'op13_licence_scan'):\n"
        "    assert entry.queries()[key](spark, '/root/testdata/sf0.001').count() > 0\n"
        "print('done')\n")
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True,
                         timeout=600, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert ran.stdout.strip().endswith("done"), ran.stderr[-2000:]
