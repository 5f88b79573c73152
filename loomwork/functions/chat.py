"""Chat records: nesting, rendering, requests and replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers of the chat format.
START, END = "<|im_start|>", "<|im_end|>"
IMAGE_SLOT = "<|vision_start|><|image_pad|><|vision_end|>"
IMAGE_NOTE = "[图像]"
USER_NAME, ASSISTANT_NAME = "用户", "助手"
HTTP_ERROR, CALL_ERROR = "错误: HTTP", "请求错误:"

# Turns that are gathered in one task; a longer conversation is put together from such pieces.
PIECE_TURNS = 1_000

REPLY = "choices ARRAY<STRUCT<message: STRUCT<role: STRING, content: STRING>>>"


def piece_of(turn: Column, piece_turns: int | None = None) -> Column:
    """Piece of a conversation that a turn belongs to; 0 for all but very long ones."""
    return F.coalesce(F.floor(turn / F.lit(piece_turns or PIECE_TURNS)).cast("long"), F.lit(0))


def pieces(turns: DataFrame, piece_turns: int | None = None) -> DataFrame:
    """(conv_id, piece, turns ARRAY in order): the rows of a very long conversation in several groups."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id", piece_of(F.col("turn"), piece_turns).alias("piece")).agg(ordered.alias("turns"))


def nest_turns(turns: DataFrame, piece_turns: int | None = None) -> DataFrame:
    """(conv_id, turn, role, text) rows to records (id, image, conversations), one per conversation.

    A record holds its whole conversation, so a row is as long as that; turns are
    gathered and sorted in pieces.
    """
    whole = pieces(turns, piece_turns).groupBy("conv_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "turns"))),
                              lambda p: p["turns"])).alias("_turns"))
    return whole.select(
        F.col("conv_id").cast("string").alias("id"),
        F.concat(F.lit("images/"), F.col("conv_id"), F.lit(".jpg")).alias("image"),
        F.transform("_turns", lambda t: F.struct(t["role"].alias("from"), t["text"].alias("value")))
        .alias("conversations"))


def turn_block(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def render_chatml(conversations: Column, on_text=lambda text: text) -> Column:
    """All turns in order; a role other than user is written as assistant."""
    def one(turn):
        role = F.when(turn["from"] == "user", "user").otherwise("assistant")
        return turn_block(role, on_text(turn["value"]))
    return F.array_join(F.transform(conversations, one), "")


def render_chatml_vision(question: Column) -> Column:
    """A user turn with an image slot, and an open assistant turn."""
    return F.concat(turn_block(F.lit("user"), F.concat(F.lit(IMAGE_SLOT), question)),
                    F.lit(f"{START}assistant\n"))


def strip_image_tag(text: Column) -> Column:
    """With both tags present, the part between the first and second closing tag."""
    both = text.contains("<img>") & text.contains("</img>")
    return F.when(both, F.split(text, "</img>", -1).getItem(1)).otherwise(text)


def replace_image_tag(text: Column, note: str = IMAGE_NOTE) -> Column:
    """Each image tag becomes a note; a tag that spans a line break stays."""
    return F.regexp_replace(text, "<img>.*?</img>", note)


def cut_prompt(rendered: Column) -> Column:
    """Text before the first assistant turn, and a new open assistant turn."""
    return F.concat(F.substring_index(rendered, f"{START}assistant", 1),
                    F.lit(f"{START}assistant\n"))


def generated_suffix(response: Column, prompt: Column) -> Column:
    """The response without its first length(prompt) characters."""
    return F.substr(response, F.length(prompt) + 1)


def multipart_messages(conversations: Column, image: Column) -> Column:
    """Messages with typed parts: image and text for a user, plain text for others."""
    empty = F.lit(None).cast("string")

    def parts(turn):
        asked = F.array(
            F.struct(F.lit("image").alias("type"), image.alias("image"), empty.alias("text")),
            F.struct(F.lit("text").alias("type"), empty.alias("image"),
                     strip_image_tag(turn["value"]).alias("text")))
        plain = F.array(F.struct(F.lit("plain").alias("type"), empty.alias("image"),
                                 turn["value"].alias("text")))
        is_user = turn["from"] == "user"
        return F.struct(F.when(is_user, "user").otherwise("assistant").alias("role"),
                        F.when(is_user, asked).otherwise(plain).alias("content"))
    return F.transform(conversations, parts)


def chat_request_json(messages: Column, model: str, temperature: float = 0.7,
                      max_tokens: int = 500) -> Column:
    """Body of a chat completion request."""
    return F.to_json(F.struct(
        F.lit(model).alias("model"), messages.alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(int(max_tokens)).alias("max_tokens"), F.lit(False).alias("stream")))


def chat_reply_parse(status: Column, body: Column, failure: Column) -> Column:
    """Reply text, or an error text for a bad status or a call that failed (status null)."""
    content = F.from_json(body, REPLY)["choices"].getItem(0)["message"]["content"]
    return (F.when(status.isNull(), F.concat(F.lit(f"{CALL_ERROR} "), failure))
            .when(status == 200, content)
            .otherwise(F.concat(F.lit(f"{HTTP_ERROR} "), status, F.lit(" - "), body)))


def history_line(number: Column, role: Column, text: Column) -> Column:
    """'<number>. <role name>: <text>'."""
    name = F.when(role == "user", USER_NAME).otherwise(ASSISTANT_NAME)
    return F.concat(number.cast("string"), F.lit(". "), name, F.lit(": "), text)


def json_request_reply(body: Column, field: str = "name") -> Column:
    return F.concat(F.lit("Hello "), F.get_json_object(body, f"$.{field}"), F.lit("!"))
