"""Native expressions that turn raw text fields into typed values.

Each returns NULL for text the field type does not admit, so that the caller
can tell a bad field from a blank one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters treated as white space around a field.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    chr(c) for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
# Texts that stand for "no amount".
BLANK_AMOUNTS = ["", "NA", "NULL", "-"]

MAX_DOUBLE = 1.7976931348623157e308


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


# Digits may be grouped by single underscores; nothing else may hide in a number.
_DIGITS = "[0-9]+(?:_[0-9]+)*+"
_INTEGER = rf"^[+-]?{_DIGITS}\z"
_DECIMAL = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"


def _ungrouped(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def stripped_amount(text: Column) -> Column:
    plain = F.translate(text, ",.", ".")
    value = _ungrouped(plain).try_cast("double")
    return F.when(plain.rlike(_DECIMAL), F.when(F.abs(value) <= MAX_DOUBLE, value)).when(
        F.upper(text).isin(BLANK_AMOUNTS), F.lit(0.0)
    )


def br_number(text: Column) -> Column:
    """``1.234,56`` -> 1234.56, blank markers -> 0.0, anything else -> NULL.

    The pattern keeps out what a Spark cast would accept beyond a plain decimal
    (``1d``, ``NaN``, ``Infinity``); a number too large for a double is refused.
    """
    return stripped_amount(strip(text))


def operation_count(text: Column) -> Column:
    """Empty -> 0, an integer -> its value, anything else -> NULL."""
    stripped = strip(text)
    return F.when(text == "", F.lit(0).cast("bigint")).when(
        stripped.rlike(_INTEGER), _ungrouped(stripped).try_cast("bigint")
    )


def reference_date(text: Column, strict_iso: bool = False) -> Column:
    """ISO date; unless strict also ``YYYYMM`` (first of month) and ``YYYYMMDD``."""
    stripped = strip(text)
    iso = F.when(stripped.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), stripped)
    if not strict_iso:
        for digits, pattern in ((6, "$1-$2-01"), (8, "$1-$2-$3")):
            parts = "([0-9]{4})([0-9]{2})" + "([0-9]{2})" * (digits == 8)
            dashed = F.regexp_replace(stripped, rf"^{parts}\z", pattern)
            iso = iso.when(stripped.rlike(rf"^[0-9]{{{digits}}}\z"), dashed)
    return iso.try_cast("date")


def without_lead(line: Column) -> Column:
    return F.ltrim(line, F.lit(WHITESPACE))


def is_header(line: Column) -> Column:
    """Header lines may carry a byte-order mark and an opening quote."""
    bare = F.ltrim(F.ltrim(without_lead(line), F.lit("\ufeff")), F.lit('"'))
    return F.lower(F.substring(bare, 1, 9)).isin("data_base", "data-base")


# One field, introduced by its separator: either quoted text, with what follows
# its closing quote kept as plain text, or a run without a separator.
_FIELD = r';(?:"((?:[^"]++|"")*+)(?:"([^;]*+)|\z)|([^;]*+))'


def split_fields(line: Column) -> Column:
    """Fields of one ``;``-separated line with ``"`` quoting, as an array."""
    led = F.concat(F.lit(";"), line)
    quoted, after, bare = (F.regexp_extract_all(led, F.lit(_FIELD), F.lit(g)) for g in (1, 2, 3))
    general = F.transform(
        F.arrays_zip(quoted.alias("q"), after.alias("a"), bare.alias("b")),
        lambda f: F.concat(F.replace(f["q"], F.lit('""'), F.lit('"')), f["a"], f["b"]),
    )
    # All fields quoted and no quote inside one: such a line is cut at its separators.
    quote = F.lit('"')
    inner = F.substring(line, 2, F.length(line) - 2)
    enclosed = (F.length(line) > 1) & F.startswith(line, quote) & F.endswith(line, quote)
    plain = enclosed & ~F.contains(F.replace(inner, F.lit('";"'), F.lit("")), quote)
    return (
        F.when(~F.contains(line, quote), F.split(line, ";", -1))
        .when(plain, F.split(inner, '";"', -1))
        .otherwise(general)
    )


# The shape nearly every line has: all fields quoted, an ISO date, texts of Latin
# characters without surrounding blanks, a plain count and plain decimals. Such a
# line is cut and cast as a whole; any other goes field by field. Possessive and
# written out, the pattern reads a line once.
_CLEAN_DATE = '"[0-9]{4}-[0-9]{2}-[0-9]{2}"'
_CLEAN_TEXT = r'"(?! )[ !#-~\x{a1}-\x{ff}]*+(?<! )"'
_CLEAN_COUNT = '"[0-9]{1,18}+"'
_CLEAN_AMOUNT = '"-?[0-9][0-9.]{0,40}+(?:,[0-9]{0,40}+)?+"'


def clean_line_pattern(texts: int, amounts: int) -> str:
    parts = [_CLEAN_DATE, *[_CLEAN_TEXT] * texts, _CLEAN_COUNT, *[_CLEAN_AMOUNT] * amounts]
    return "^" + ";".join(parts) + r"\z"


def clean_head(line: Column, fields: int) -> Column:
    """The first fields of a clean line."""
    return F.split(F.substring(F.substring_index(line, '";"', fields), 2, 2**31 - 1), '";"', -1)


def clean_amounts(line: Column, amounts: int) -> Column:
    """The last fields of a clean line, as an array of doubles."""
    tail = F.substring_index(line, '";"', -amounts)
    for old, new in (('"', ""), (".", ""), (",", ".")):
        tail = F.replace(tail, F.lit(old), F.lit(new))
    return F.split(tail, ";", -1).try_cast("array<double>")
