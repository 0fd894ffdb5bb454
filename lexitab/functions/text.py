"""Column expressions for keys, text clean-up and the exact CSV byte layout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The character classes of the CSV dialect and of whitespace.
NEEDS_QUOTES = r'[,"\r\n]'
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
NOT_WHITESPACE = r"(?U)[^\s\x1c-\x1f]"
LINE_END = "\r\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(title: Column | str) -> Column:
    """Key used for ordering and matching; output rows keep their own casing."""
    return F.lower(_col(title))


def _capital(letter: Column) -> Column:
    """The capital of one letter, where it is one letter too: ``upper`` makes SS of ß, whose fold is another."""
    return F.when(F.length(F.upper(letter)) == 1, F.upper(letter)).when(letter == "ß", "ẞ").otherwise(letter)


def capitals(title: Column | str) -> Column:
    """All letters upper, each by itself, so that the title has as many as before."""
    return F.array_join(F.transform(F.split(_col(title), ""), _capital), "")


def capitalize(word: Column | str) -> Column:
    """First character upper, all others lower (``initcap`` would touch every word)."""
    word = _col(word)
    return F.concat(_capital(F.substring(word, 1, 1)), F.lower(word.substr(F.lit(2), F.length(word))))


def normalize(text: Column | str) -> Column:
    """One line of text: every run of whitespace becomes a single blank, ends are trimmed."""
    return F.trim(F.regexp_replace(_col(text), WHITESPACE, " "))


def has_text(text: Column | str) -> Column:
    """Whether ``normalize`` leaves anything; stops at the first character that stays."""
    return _col(text).rlike(NOT_WHITESPACE)


def utf8_bytes(text: Column | str) -> Column:
    return F.octet_length(_col(text))


def csv_field(field: Column | str) -> Column:
    """Quote a field only if it must be, doubling inner quotes."""
    field = _col(field)
    quoted = F.concat(F.lit('"'), F.replace(field, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(field.rlike(NEEDS_QUOTES), quoted).otherwise(field)


def csv_line(title: Column | str = "title", value: Column | str = "value") -> Column:
    """A dictionary row as CSV text without its line end."""
    return F.concat(csv_field(title), F.lit(","), csv_field(value))


def _field_bytes(field: Column | str) -> Column:
    field = _col(field)
    inner_quotes = F.octet_length(field) - F.octet_length(F.replace(field, F.lit('"'), F.lit("")))
    return F.octet_length(field) + F.when(field.rlike(NEEDS_QUOTES), inner_quotes + 2).otherwise(0)


def row_bytes(title: Column | str = "title", value: Column | str = "value") -> Column:
    """Bytes of the encoded row with its line end, computed without building the line."""
    return (_field_bytes(title) + 1 + _field_bytes(value) + len(LINE_END)).cast("int")


def without_line_end(line: Column | str) -> Column:
    return F.rtrim(_col(line), F.lit(LINE_END))


def _parsed(line: Column | str) -> Column:
    return F.from_csv(without_line_end(line), "title string, value string", {"escape": '"', "multiLine": "true"})


def csv_title(line: Column | str) -> Column:
    """The title of one CSV record; Spark then parses no further than it has to."""
    return F.coalesce(_parsed(line)["title"], F.lit(""))


def csv_decode(line: Column | str) -> Column:
    """Struct ``(title, value)`` of one CSV record, parsed once; its line end may be attached."""
    return F.transform(F.array(_parsed(line)), lambda row: F.struct(
        F.coalesce(row["title"], F.lit("")).alias("title"),
        F.coalesce(row["value"], F.lit("")).alias("value")))[0]


def json_text(text: Column | str) -> Column:
    """A string as JSON writes it, with its quotes."""
    made = F.to_json(F.struct(_col(text).alias("t")))
    return F.substring(made, F.lit(6), F.length(made) - 6)


def date_stamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd")


def iso_stamp(ts: Column | str) -> Column:
    """ISO form of a timestamp; like Python's, it leaves out a zero fraction."""
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))
