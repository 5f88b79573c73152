"""Operator 6, format-preserving pseudonyms for personal data, in DataFrame functions only.

Numbers, dates and addresses are found by pattern, validated (a long number or an
account number without right check digits stays, so does a social number with a zero
part), and replaced by a keyed permutation within their own format: a card number
becomes another card number with a right check digit, a date another date of the same
layout, an address another address.  Equal values get equal pseudonyms in every
document, different values of one format different ones, and whoever has the key can
reverse them.  Separators of cards, accounts and phone numbers, and the layout of a
date, are no part of the value: it is permuted bare and laid out as it was.  A country
code stays.  Dates with slashes are read month first where that can be; the pseudonym
of one that must be day first may itself be readable month first.  Mailboxes keep
their domain; letters outside the listed scripts stay.

The permutation is a Feistel network.  Its two halves are arrays of symbols, each
symbol within its own range (ten digits, 26 letters, 256 byte values); a round adds
to one half, symbol by symbol, numbers taken from a keyed SHA-256 of the other
half.  Dates are two numbers whose ranges multiply to the days of two centuries.

A text is cut by the pattern into what lies between the matches (``split``) and
the matches (``regexp_extract_all``); both come from the same scan, so they join
again exactly.  Texts without a digit or ``@`` are passed on untouched.

A null text stays null with no values.  Empty texts stay empty.  Very long texts are
searched whole.  Repeated rows get equal results.  An empty table gives an empty result.  All columns are kept; the
count of replaced values is added under a name of the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.columns import unused

ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)    # 17 * 4297 days: 1900 to 2099

_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LETTER = r"\p{L}\p{M}\p{N}"
_YEAR, _MONTH, _DAY = "(?:19|20)[0-9]{2}", "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])"
# Kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": rf"[\p{{L}}\p{{N}}][{_LETTER}._%+-]{{0,63}}@[{_LETTER}](?:[{_LETTER}.-]{{0,252}}[{_LETTER}])?\.[\p{{L}}\p{{M}}]{{2,24}}",
    "address": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "date": "|".join([*[f"{_YEAR}{sep}{_MONTH}{sep}{_DAY}" for sep in ("-", "/", r"\.")],
                      rf"{_DAY}\.{_MONTH}\.{_YEAR}", f"{_MONTH}/{_DAY}/{_YEAR}", f"{_DAY}/{_MONTH}/{_YEAR}"]),
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}"
             r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}|[0-9]{3}[.-][0-9]{3,4}[.-][0-9]{4}|[2-9][0-9]{9}",
    "social": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "number": r"[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19}",
}
# Country codes of telephone numbers; all others have three digits.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# First and last code point of digits and letters, and of runs of letters beyond ASCII.
ASCII = [(48, 57), (97, 122), (65, 90)]
LETTERS = [(0xC0, 0xD6), (0xD8, 0xDE), (0xDF, 0xF6), (0xF8, 0xFF), (0x100, 0x17F), (0x391, 0x3A1), (0x3B1, 0x3C9),
           (0x410, 0x42F), (0x430, 0x44F), (0x5D0, 0x5EA), (0x621, 0x63A), (0x641, 0x64A), (0x905, 0x939),
           (0xE01, 0xE2E), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]


def _bounded(kind: str, pattern: str) -> str:
    before = r"(?<![\p{L}\p{N}+(])" if kind == "phone" else "" if kind == "address" else _BEFORE
    after = "" if kind == "address" else _AFTER
    return f"{before}(?:{pattern}){after}"


ANY = "|".join(_bounded(k, p) for k, p in PATTERNS.items())


def _digits(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c.rlike("^[0-9]$"))


def _drawn(key: str, tag: Column, round_: Column, half: Column, place: Column) -> Column:
    """A number below 65536 for a place, from the keyed digest of the other half."""
    text = F.concat_ws("|", F.lit(key), tag, round_.cast("string"), F.array_join(half, ","))
    at = (place % 16) * 4 + 1
    return F.conv(F.substr(F.sha2(text, 256), at, F.lit(4)), 16, 10).cast("int")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _symbols(half: Column) -> Column:
    return F.transform(half, lambda u: u["sym"].cast("string"))


def feistel(units: Column, key: str, tag: Column) -> Column:
    """Permute an array of structs (sym, base, ...): each ``sym`` stays within 0..base-1."""
    def halves(units):
        half = (F.size(units) / 2).cast("int")
        return F.struct(F.slice(units, F.lit(1), half).alias("a"),
                        F.slice(units, half + 1, F.size(units) - half).alias("b"))

    def swap(pair, round_):
        other = _symbols(pair["a"])
        # one digest per sixteen symbols' worth of places; all places share the digest of the other half
        moved = F.transform(pair["b"], lambda u, i: u.withField(
            "sym", F.pmod(u["sym"] + _drawn(key, tag, round_, other, i), u["base"]).cast("int")))
        return F.struct(moved.alias("a"), pair["a"].alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _let(units, halves), swap,
                       lambda done: F.concat(done["a"], done["b"]))


def _units(value: Column, fixed: Column, ranges: list[tuple[int, int]]) -> Column:
    """Characters as structs (place, base, zero, sym), symbols within the ranges; base 0 marks what never changes."""

    def size(zero):
        out = F.when(zero == 0, 0)
        for first, last in ranges:
            out = out.when(zero == first, last - first + 1)
        return out

    def unit(c, i):
        code = F.ascii(c)
        low = F.when(i < fixed, 0)
        for first, last in ranges:
            low = low.when(code.between(first, last), first)
        return _let(low.otherwise(0), lambda zero: F.struct(
            i.alias("place"), size(zero).alias("base"),
            zero.alias("zero"), (code - zero).alias("sym"), c.alias("char")))
    return F.transform(F.split(value, ""), unit)


def _character(code: Column) -> Column:
    wide = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
    return F.when(code < 128, F.char(code.cast("bigint"))).otherwise(wide)


def permuted(value: Column, key: str, kind: str, fixed: Column | None = None) -> Column:
    """Permute digits among digits and letters among letters; other characters and the ``fixed`` first ones stay.

    The layout is no part of the key, so a number written with other separators keeps its pseudonym.
    """
    def put(units):
        moving = F.filter(units, lambda u: u["base"] > 0)
        moved = _let(moving, lambda m: feistel(m, key, F.concat(F.lit(kind + ":"), F.size(m).cast("string"))))
        shown = F.transform(moved, lambda u: F.struct(u["place"].alias("place"),
                                                      _character(u["sym"] + u["zero"]).alias("char")))
        kept = F.transform(F.filter(units, lambda u: u["base"] == 0),
                           lambda u: F.struct(u["place"].alias("place"), u["char"].alias("char")))
        return F.array_join(F.transform(F.array_sort(F.concat(shown, kept)), lambda u: u["char"]), "")
    ranges = ASCII + LETTERS if kind == "email" else ASCII
    return _let(_units(value, F.lit(0) if fixed is None else fixed, ranges), put)


def check_digit(digits: Column) -> Column:
    """The digit that completes a string of digits under the mod-10 rule."""
    order = F.reverse(F.transform(_digits(digits), lambda d: d.cast("int")))
    total = F.aggregate(F.transform(order, lambda d, i: F.when(
        i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)), F.lit(0), lambda s, d: s + d)
    return F.pmod(-total, F.lit(10)).cast("string")


def card_valid(value: Column) -> Column:
    """Whether a number's digits end in their check digit."""
    plain = F.regexp_replace(value, "[^0-9]", "")
    return check_digit(F.substr(plain, F.lit(1), F.length(plain) - 1)) == F.substr(plain, F.length(plain), F.lit(1))


def _card(value: Column, key: str) -> Column:
    """A card number with a right check digit becomes another one."""
    moved = permuted(F.substr(value, F.lit(1), F.length(value) - 1), key, "card")
    return _let(moved, lambda m: F.concat(m, check_digit(m)))


def _remainder97(value: Column) -> Column:
    """The remainder by 97 of an account number whose letters count from 10."""
    def add(total, c):
        code = F.ascii(c)
        return F.when(code < 65, total * 10 + code - 48).otherwise(total * 100 + code - 55) % 97
    return F.aggregate(F.split(F.regexp_replace(value, " ", ""), ""), F.lit(0), add)


def _country_last(value: Column) -> Column:
    return F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))


def iban_valid(value: Column) -> Column:
    """Whether an account number has 15 to 34 characters and right check digits."""
    return F.length(F.regexp_replace(value, " ", "")).between(15, 34) & (_remainder97(_country_last(value)) == 1)


def _iban(value: Column, key: str) -> Column:
    """An account number with right check digits becomes another one of its country."""
    def checked(moved):
        country, rest = F.substr(moved, F.lit(1), F.lit(2)), F.substr(moved, F.lit(5))
        digits = F.lit(98) - _remainder97(F.concat(rest, country, F.lit("00")))
        return F.concat(country, F.lpad(digits.cast("string"), 2, "0"), rest)
    return _let(permuted(value, key, "iban", F.lit(4)), checked)


def _social(value: Column, key: str) -> Column:
    """Area, group and serial number, none of which is ever zero."""
    sizes = (3, 2, 4)
    parts = F.split(value, "-")
    units = F.array(*[F.struct((parts[i].cast("int") - 1).alias("sym"), F.lit(10 ** n - 1).alias("base"))
                      for i, n in enumerate(sizes)])
    return _let(feistel(units, key, F.lit("social")), lambda m: F.concat_ws("-", *[
        F.lpad((m[i]["sym"] + 1).cast("string"), n, "0") for i, n in enumerate(sizes)]))


def _address(value: Column, key: str) -> Column:
    units = F.transform(F.split(value, r"\."), lambda o: F.struct(o.cast("int").alias("sym"), F.lit(256).alias("base")))
    return F.array_join(_symbols(feistel(units, key, F.lit("address"))), ".")


def _layout(value: Column) -> Column:
    """The date pattern of a match: year first, or month first with slashes while that can be, else day first."""
    return (F.when(value.rlike("^[0-9]{4}"), F.replace(F.lit("yyyy-MM-dd"), F.lit("-"), F.substr(value, F.lit(5), F.lit(1))))
            .when(value.rlike(r"\."), "dd.MM.yyyy")
            .when(F.substr(value, F.lit(1), F.lit(2)) <= "12", "MM/dd/yyyy").otherwise("dd/MM/yyyy"))


def _days(value: Column) -> Column:
    part = F.split(value, "[-/.]")
    iso = (F.when(F.length(part[0]) == 4, F.concat_ws("-", part[0], part[1], part[2]))
           .when(_layout(value) == "MM/dd/yyyy", F.concat_ws("-", part[2], part[0], part[1]))
           .otherwise(F.concat_ws("-", part[2], part[1], part[0])))
    return F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.to_date(F.lit(FIRST_DAY)))


def _date(value: Column, key: str) -> Column:
    low, high = DAYS

    def moved(day):
        unit = [F.struct((day % low).cast("int").alias("sym"), F.lit(low).alias("base")),
                F.struct(F.floor(day / low).cast("int").alias("sym"), F.lit(high).alias("base"))]
        return _let(feistel(F.array(*unit), key, F.lit("date")),
                    lambda m: F.date_add(F.to_date(F.lit(FIRST_DAY)), m[0]["sym"] + m[1]["sym"] * low))
    def laid_out(new):
        shown = _layout(value)
        for part in ("yyyy", "MM", "dd"):
            shown = F.replace(shown, F.lit(part), F.date_format(new, part))
        return shown
    return _let(_let(_days(value), moved), laid_out)


def _is_a(value: Column, kind: str) -> Column:
    return value.rlike(f"^(?:{PATTERNS[kind]})$")


def _hidden_card(value: Column) -> Column:
    """What follows the first four characters of something that looks like an account number."""
    return F.ltrim(F.substr(value, F.lit(5)))


def _holds_card(value: Column) -> Column:
    return _is_a(_hidden_card(value), "number") & card_valid(_hidden_card(value))


def validated(value: Column) -> Column:
    """Whether a match is what it looks like: long numbers and accounts need right check digits, dates a place in the calendar."""
    return (F.when(_is_a(value, "email"), True)
            .when(_is_a(value, "date"), _days(value).isNotNull())
            .when(_is_a(value, "iban"), iban_valid(value) | _holds_card(value))
            .when(_is_a(value, "social"), ~value.rlike("^000|-00-|0000$"))
            .when(_is_a(value, "number"), card_valid(value)).otherwise(True))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one match of ``ANY``; what is not validated stays."""
    country = F.length(F.regexp_extract(value, COUNTRY, 0))
    return (F.when(F.contains(value, F.lit("@")), F.concat(
                permuted(F.substring_index(value, "@", 1), key, "email"), F.lit("@"),
                F.substring_index(value, "@", -1)))
            .when(_is_a(value, "address"), _address(value, key))
            .when(~validated(value), value)
            .when(_is_a(value, "date"), _date(value, key))
            .when(_is_a(value, "iban"), F.when(iban_valid(value), _iban(value, key)).otherwise(F.concat(
                F.substr(value, F.lit(1), F.length(value) - F.length(_hidden_card(value))),
                _card(_hidden_card(value), key))))
            .when(_is_a(value, "social"), _social(value, key))
            .when(_is_a(value, "number"), _card(value, key))
            .otherwise(permuted(value, key, "phone", country)))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """All columns, the text with every value replaced; ``count`` names a column for the number of values."""
    whole = F.col(text)
    matches = F.regexp_extract_all(whole, F.lit(f"({ANY})"), F.lit(1))
    between = F.split(whole, ANY, -1)
    new = F.transform(matches, lambda m: pseudonym(m, key))
    rebuilt = F.array_join(F.zip_with(between, new, lambda part, value: F.concat(
        part, F.coalesce(value, F.lit("")))), "")
    candidate = whole.rlike("[0-9@]")
    values = unused(docs, "_values")   # counted before the text changes, named afterwards
    out = docs.withColumn(values, F.when(candidate, F.size(F.filter(matches, validated))).otherwise(0)) if count else docs
    out = out.withColumn(text, F.when(candidate & whole.rlike(ANY), rebuilt).otherwise(whole))
    return out.withColumnRenamed(values, count) if count else out
