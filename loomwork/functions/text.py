"""Text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: cleaning deletes line feeds and all but ASCII letters, digits, . , ? ! and
# white space (the Unicode kind).  Written as the ranges that go: the regular expression
# engine tests ranges several times faster than a negated class.
SPECIAL = (r"[\x00-\x08\n\x0e-\x1b\x22-\x2b\x2d\x2f\x3a-\x3e\x40\x5b-\x60\x7b-\x84\x86-\x9f"
           r"\xa1-\u167f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u2fff"
           r"\u3001-\x{10ffff}]+")
SENTENCE_GAP = r"(?<=[.?!])\s+"


def words(text: Column) -> Column:
    """Tokens between single spaces; empty tokens and line breaks stay."""
    return F.split(text, " ", -1)


def lower_words(text: Column) -> Column:
    """Lower-case tokens between runs of white space, none empty."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def clean_special_chars(text: Column) -> Column:
    """Delete special characters and line feeds, so words around them join."""
    return F.regexp_replace(text, SPECIAL, "")


def sentences(text: Column) -> Column:
    """Cut after . ? or ! followed by white space; empty pieces are dropped."""
    return F.filter(F.split(F.trim(text), SENTENCE_GAP), lambda s: s != "")


def preview(text: Column, length: int, always: bool = False) -> Column:
    """First characters and '...', by default only where something was cut."""
    cut = F.concat(F.substring(text, 1, length), F.lit("..."))
    return cut if always else F.when(F.length(text) > length, cut).otherwise(text)


def label_name(label: Column, names: dict[int, str], unknown: str) -> Column:
    """Name of a label; '<unknown> <label>' for one that is not listed."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.when(label.isNotNull(), F.coalesce(
        F.try_element_at(table, label), F.concat(F.lit(f"{unknown} "), label.cast("string"))))


def first_letter_bucket(word: Column, buckets: int) -> Column:
    """Code point of the first character modulo ``buckets``."""
    return F.pmod(F.ascii(word), F.lit(buckets))


def replace_words(tokens: Column, table: dict[str, str]) -> Column:
    """Tokens replaced by their entry in a small fixed table, others kept."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(entries, t), t))
