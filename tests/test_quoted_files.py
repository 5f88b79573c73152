"""Quoted files are read by many tasks, with the rows one task would give."""

import csv
import io
import random

import pytest

from loomwork.session import new_folder
from loomwork.sources import files

KIND = "id long, text string, label double"


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def use(size):
        for name in names:
            spark.conf.set(name, str(size))
    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def _text(draw):
    pieces = ["\n", '"', ",", "\t", "\r\n", "é", "word", " ", '"\n', "\n\n"]
    return "".join(draw.choice(pieces) for _ in range(draw.choice([0, 1, 3, 20, 400])))


def _write(folder, rows, end="\n", sep=","):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=sep, lineterminator=end, quoting=csv.QUOTE_ALL)
    writer.writerow(["id", "text\nwith a break", "label"])
    writer.writerows(rows)
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.csv").write_bytes(out.getvalue().encode())


def _sorted(rows):
    return sorted(((r["id"], r["text"], r["label"]) for r in rows), key=repr)


@pytest.mark.parametrize("size", [64, 700, 50_000, 10_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split_gives_the_same_rows(spark, small_splits, tmp_path, size, end):
    draw, want = random.Random(size), []
    count = 25 if size == 64 else 200
    for part in range(3):
        rows = [(part * 1000 + i, _text(draw), draw.choice([0.0, 1.5])) for i in range(count)]
        _write(tmp_path / "in", rows, end)
        want += [(i, text or None, label) for i, text, label in rows]
    small_splits(size)
    got = files.read_notes_csv(spark, str(tmp_path / "in"), KIND).collect()
    assert _sorted(got) == sorted(want, key=repr)


def test_a_record_longer_than_many_splits(spark, small_splits, tmp_path):
    rows = [(1, "a\n" * 5000, 1.0), (2, "", 0.0), (3, 'x"' * 3000, 1.0), (4, "last", 0.0)]
    _write(tmp_path / "in", rows, sep="\t")
    small_splits(500)
    got = files.read_labelled_tsv(spark, str(tmp_path / "in"), KIND).collect()
    assert _sorted(got) == sorted([(i, t or None, v) for i, t, v in rows], key=repr)


def test_one_file_is_read_by_many_tasks(spark, small_splits, tmp_path):
    _write(tmp_path / "in", [(i, "line\n\nbreak", 0.0) for i in range(2000)])
    small_splits(4096)
    records = files.quoted_records(spark, str(tmp_path / "in"))
    assert files._lines(spark, str(tmp_path / "in")).rdd.getNumPartitions() > 8
    assert records.count() == 2000


def test_empty_files_and_blank_lines(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "empty.csv").write_text("")
    (folder / "header.csv").write_text("id,text,label\n")
    (folder / "blank.csv").write_text('id,text,label\n\n1,"a",2.0\n\n2,,\n3,open end,1.0')
    got = files.read_notes_csv(spark, str(folder), KIND).collect()
    assert _sorted(got) == [(1, "a", 2.0), (2, None, None), (3, "open end", 1.0)]


def test_equal_to_the_one_task_reader(spark, small_splits, sf):
    path = new_folder(spark, "notes")
    documents = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id AS id", "text", "1D AS label")
    files.write_delimited(documents.coalesce(1), path, ",")
    one = (spark.read.schema(KIND).csv(path, header=True, multiLine=True, escape='"', nullValue="", emptyValue=""))
    small_splits(20_000)
    assert _sorted(files.read_notes_csv(spark, path, KIND).collect()) == _sorted(one.collect())
