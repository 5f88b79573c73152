"""Text and chat expressions on literals."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from loomwork.functions import chat, html
from loomwork.functions import text as tx
from loomwork.operators import counts, history, inference, tokens
from loomwork.session import new_folder
from loomwork.sources import files, tables, sinks


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [
    ("a  b ", ["a", "", "b", ""]), ("", [""]), ("x\ny z", ["x\ny", "z"])])
def test_words_keep_empties(spark, text, want):
    assert one(spark, tx.words(F.col("t")), t=text) == want


@pytest.mark.parametrize("text,want", [(" The\tthe \n", ["the", "the"]), ("   ", []), ("", [])])
def test_lower_words(spark, text, want):
    assert one(spark, tx.lower_words(F.col("t")), t=text) == want


@pytest.mark.parametrize("text", [
    "Temp: 38.5°C\nnext-line, ok? yes!", "naïve café x　y", "tab\tstays\x0b\x1c\x85.", "a_b{c}~[d]^`@#$%&*()\x00é"])
def test_cleaning_matches_the_negated_class(spark, text):
    import re
    want = re.sub("[^a-zA-Z0-9\\s.,?!]+|\n", "", text)
    assert one(spark, tx.clean_special_chars(F.col("t")), t=text) == want


def test_sentences(spark):
    assert one(spark, tx.sentences(F.col("t")), t="One. Two!  Three? four") == ["One.", "Two!", "Three?", "four"]
    assert one(spark, tx.sentences(F.col("t")), t="  ") == []


def test_preview(spark):
    assert one(spark, tx.preview(F.col("t"), 3), t="abc") == "abc"
    assert one(spark, tx.preview(F.col("t"), 3), t="abcd") == "abc..."
    assert one(spark, tx.preview(F.col("t"), 5, always=True), t="abc") == "abc..."


def test_label_names(spark):
    df = spark.createDataFrame([(0,), (5,), (None,)], "l int")
    got = [r[0] for r in df.select(tx.label_name(F.col("l"), {0: "no"}, "unknown label")).collect()]
    assert got == ["no", "unknown label 5", None]


@pytest.mark.parametrize("text,question,noted", [
    ("<img>a.png</img>what?", "what?", "[图像]what?"),
    ("<img>a</img>x<img>b</img>y", "x<img>b", "[图像]x[图像]y"),
    ("<img>open only", "<img>open only", "<img>open only"),
    ("<img>a\nb</img>q", "q", "<img>a\nb</img>q"),
    ("plain", "plain", "plain")])
def test_image_tags(spark, text, question, noted):
    assert one(spark, chat.strip_image_tag(F.col("t")), t=text) == question
    assert one(spark, chat.replace_image_tag(F.col("t")), t=text) == noted


def test_corpus_file(spark):
    """Nested chat lines in, rendered {"text"} lines out."""
    records = [{"id": f"00{i}", "image": f"pics/{i}.jpg", "conversations": [
        {"from": "user", "value": f"<img>pics/{i}.jpg</img>这是什么"}, {"from": "system", "value": f"答案 {i}"}]}
        for i in range(3)]
    source = new_folder(spark, "t")
    spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in records], "value string").write.text(source)
    read = files.read_chat_jsonl(spark, source)
    assert files.chat_columns(read).columns == ["id", "image_path", "conversations"]
    target = new_folder(spark, "t")
    sinks.write_text_corpus(read.select(chat.render_chatml(
        F.col("conversations"), chat.replace_image_tag).alias("text")), target)
    lines = sorted(r["value"] for r in spark.read.text(target).collect())
    assert [json.loads(line)["text"] for line in lines] == [
        f"<|im_start|>user\n[图像]这是什么<|im_end|>\n<|im_start|>assistant\n答案 {i}<|im_end|>\n" for i in range(3)]
    assert "这是什么" in lines[0]  # written as it is, not escaped


def test_prompt_and_suffix(spark):
    text = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    prompt = one(spark, chat.cut_prompt(F.col("t")), t=text)
    assert prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    assert one(spark, chat.generated_suffix(F.col("t"), chat.cut_prompt(F.col("t"))), t=text) == "yo<|im_end|>\n"


def test_requests_and_replies(spark):
    assert one(spark, chat.json_request_reply(F.col("b")), b='{"name": "Ann"}') == "Hello Ann!"
    rows = spark.createDataFrame(
        [(200, '{"choices":[{"message":{"role":"assistant","content":"hi"}}]}', None), (503, "busy", None),
         (None, None, "timed out")], "s int, b string, e string")
    got = [r[0] for r in rows.select(chat.chat_reply_parse(F.col("s"), F.col("b"), F.col("e"))).collect()]
    assert got == ["hi", "错误: HTTP 503 - busy", "请求错误: timed out"]


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", f"c{c}t{i}") for c, n in ((1, 9), (2, 2)) for i in range(n)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("piece", [1, 4, 1000])
def test_conversations_are_complete(spark, turns, piece):
    """Whatever the size of the pieces, a record holds all turns and a history all earlier ones."""
    records = {int(r["id"]): [t["value"] for t in r["conversations"]] for r in chat.nest_turns(turns, piece).collect()}
    assert records == {c: [f"c{c}t{i}" for i in range(n)] for c, n in ((1, 9), (2, 2))}
    rows = history.conversation_history(turns, piece).collect()
    assert len(rows) == 5
    for r in rows:
        assert [m["content"] for m in r["messages"]] == [f"c{r['conv_id']}t{i}" for i in range(r["turn"])]
    bodies = {(r["conv_id"], r["turn"]): json.loads(r["body"]) for r in history.chat_requests(turns, "m", piece).collect()}
    assert bodies[1, 3] == {
        "model": "m", "messages": [{"role": ["user", "assistant"][i % 2], "content": f"c1t{i}"} for i in range(3)],
        "temperature": 0.7, "max_tokens": 500, "stream": False}


def test_conversation_of_2500_turns(spark):
    rows = spark.range(2500).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    record, = chat.nest_turns(rows).collect()
    assert [t["value"] for t in record["conversations"]] == [f"t{i}" for i in range(2500)]
    late = {r["turn"]: r["messages"] for r in history.conversation_history(rows).where("turn in (999, 1001, 2499)").collect()}
    assert {k: len(v) for k, v in late.items()} == {999: 999, 1001: 1001, 2499: 2499}
    assert [m["content"] for m in late[2499]] == [f"t{i}" for i in range(2499)]


@pytest.mark.parametrize("page,want", [
    ('<a href="/x">x</a><A HREF=/y>y</A><a>no</a><article href="n">', [(1, "/x"), (2, "/y"), (3, None)]),
    ("<script>'<a href=1>'</script><!-- <a href=2> --><style><a></style><a title='>' href='/q?a=1&amp;b=2'>z",
     [(1, "/q?a=1&b=2")]),
    ('<a href="">e</a>', [(1, "")]), ("", [])])
def test_anchors(spark, page, want):
    got = one(spark, html.anchors(F.col("p")), p=page)
    assert [(a["ordinal"], a["href"]) for a in got] == want


def test_follow_cap(spark):
    """Anchors 1..8, of which 2 and 5 have no href: 1, 3, 4 and then 6 are followed."""
    page = "".join("<a>" if i in (2, 5) else f'<a href="/{i}">' for i in range(1, 9))
    got = one(spark, html.followed(html.anchors(F.col("p")), 4), p=page)
    assert [a["ordinal"] for a in got] == [1, 3, 4, 6]


def test_word_counts(spark):
    df = spark.createDataFrame([("a b  A",), ("b",)], "t string")
    assert {tuple(r) for r in counts.word_count(df, "t").collect()} == {("a", 1), ("b", 2), ("", 1), ("A", 1)}
    assert [tuple(r) for r in counts.top(counts.word_count_lower(df, "t"), "count", "word", 5).collect()] == [
        ("a", 2), ("b", 2)]


@pytest.mark.parametrize("head", [0, 1, 50])
def test_tokens(spark, head):
    """Whether a word is in the head or joined, it gets the same id."""
    df = spark.createDataFrame([(1, "b a b c"), (2, ""), (3, "zz b [SEP] a"), (4, None)], "id long, t string")
    vocab = tokens.build_vocab(df.where("id = 1"), "t", size=4 + 2)
    assert {r["word"]: r["token_id"] for r in vocab.collect()} == {"b": 4, "a": 5}
    ids = tokens.encode(df, ["id"], tx.lower_words(F.col("t")), vocab, name="input_ids", head=head)
    got = {r["id"]: r["input_ids"] for r in ids.collect()}
    assert got == {1: [4, 5, 4, 1], 2: [], 3: [1, 4, 2, 5], 4: []}
    cut = tokens.encode(df, ["id"], tx.lower_words(F.col("t")), vocab, 2, head=head).collect()
    assert {r["id"]: r["ids"] for r in cut} == {1: [4, 5], 2: [], 3: [1, 4], 4: []}
    padded = {r["id"]: r for r in tokens.encode_pad(df, ["id"], "t", vocab, 5).collect()}
    assert padded[1]["input_ids"] == [4, 5, 4, 1, 0] and padded[1]["mask"] == [1, 1, 1, 1, 0]
    assert padded[2]["input_ids"] == [0] * 5 and padded[2]["mask"] == [0] * 5
    labels = {r["id"]: r["labels"] for r in tokens.first_segment_labels(ids).collect()}
    assert labels[3] == [1, 4, -100, -100] and labels[1] == [-100] * 4
    wide = tokens.pad_to_longest(ids.withColumnRenamed("input_ids", "ids").withColumn("b", F.lit(0)), "b")
    assert {r["width"] for r in wide.collect()} == {8}


def test_every_word_of_the_corpus_has_an_id(spark, sf):
    docs = tables.load(spark, sf, "documents").select("doc_id", "text")
    vocab = tokens.build_vocab(docs, "text")
    ids = tokens.encode(docs, ["doc_id"], tx.lower_words(F.col("text")), vocab, head=500)
    assert ids.where(F.array_contains("ids", tokens.UNK) | F.array_contains("ids", -1)).count() == 0
    assert vocab.agg(F.max("token_id")).first()[0] == vocab.count() + tokens.RESERVED - 1


def test_masking_shares(spark):
    df = spark.range(400).select("id", F.array_repeat(F.lit(9), 50).alias("ids"))
    rows = tokens.mlm_mask(df, "id", "ids", 3, 1000).collect()
    pairs = [(m, lab) for r in rows for m, lab in zip(r["masked_ids"], r["mlm_labels"])]
    chosen = [m for m, lab in pairs if lab != -100]
    assert all(m == 9 for m, lab in pairs if lab == -100)
    assert abs(len(chosen) / len(pairs) - 0.15) < 0.01
    assert abs(chosen.count(tokens.MASK) / len(chosen) - 0.8) < 0.03
    assert abs(chosen.count(9) / len(chosen) - 0.1) < 0.03


def test_shuffled_pairs_keep_their_words(spark):
    df = spark.range(200).select("id", F.array(*[F.lit(x) for x in [7, 8, 2, 11, 12, 13, 14, 15]]).alias("ids"))
    rows = tokens.nsp_examples(df, "id", 5).collect()
    assert all(r["input_ids"][:3] == [7, 8, 2] and sorted(r["input_ids"][3:]) == [11, 12, 13, 14, 15] for r in rows)
    assert all(r["input_ids"] == r["ids"] for r in rows if r["nsp_label"] == 1)
    assert 70 < sum(r["nsp_label"] for r in rows) < 130


def test_two_stages(spark):
    df = spark.createDataFrame([(1, "the cat saw the dog and the end"), (2, "too short"), (3, ""), (4, None)], "id long, t string")
    rows = inference.two_stage_inference(df, "id", "t", {"the": "le", "and": "et"}, most=5).collect()
    assert sorted((r["id"], r["summary"], r["translation"]) for r in rows) == [
        (1, "the cat saw dog and", "le cat saw dog et"), (2, "too short", "too short"), (3, "", ""), (4, "", "")]


def test_summaries_of_single_rows_move_no_words(spark):
    """Documents of one row are summarised without a shuffle, those of several rows as a whole."""
    draw = random.Random(3)
    texts = {i: [draw.choice(["The", "the", "cat", "Übung", "a,b", "x\ty"]) + draw.choice(["", str(draw.randrange(9))])
                 for _ in range(draw.randrange(60))] for i in range(80)}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "id long, t string")
    short = inference.summarize(df, "id", "t", 4)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert "Exchange" not in short._jdf.queryExecution().explainString(mode)

    def top(words):
        n = collections.Counter(words)
        first = {w: words.index(w) for w in n}
        return sorted(sorted(n, key=lambda w: (-n[w], first[w]))[:4], key=first.get)
    want = {i: top(" ".join(t).lower().split()) for i, t in texts.items()}
    assert {r["id"]: r["words"] for r in short.collect()} == want
    more = df.unionByName(spark.createDataFrame(
        [(0, None), (None, "b b c"), (None, "c d c c"), (101, "solo x solo"), (102, "p p q"), (102, "q q r r r r")],
        "id long, t string"))
    found = {r["id"]: r["words"] for r in inference.summarize(more, "id", "t", 4).where("id is null or id > 0").collect()}
    del want[0]
    assert found == want | {None: ["b", "c", "d"], 101: ["solo", "x"], 102: ["p", "q", "r"]}


def test_delimited_files(spark):
    rows = [(1, 'tab\there "quoted"\nnew line', 1.0), (2, None, 0.0), (3, " spaces , kept ", None)]
    path = new_folder(spark, "t")
    files.write_delimited(spark.createDataFrame(rows, "id long, text string, label double"), path, "\t")
    back = files.read_labelled_tsv(spark, path, "id long, text string, label double")
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_folder_listing(spark, tmp_path):
    for name in ("cats/1.png", "cats/2.png", "ants/3.png"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = {(r["path"].rsplit("/", 1)[1], r["class_name"], r["class_idx"])
           for r in files.list_labelled_files(spark, str(tmp_path), "*.png").collect()}
    assert got == {("1.png", "cats", 1), ("2.png", "cats", 1), ("3.png", "ants", 0)}
