"""License scan by canonical digest (DataFrame functions only).

A text is reduced to what a licence's identity rests on: no case, punctuation, line ends or copyright
statements, one spelling for words that have several.  The SHA-256 of that form is looked up in the digests
of known licences, for the entire text and for every single line (notices).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexitab.llm.license_texts import known, listed
from lexitab.plans.fixtures import table
from lexitab.session import materialise

# Statements at the start of a line of who holds the rights: "Copyright (c) 2020 A.", "© B", "All rights reserved."
# A bare "(c)" may also number a clause: it needs "copyright", a year, or a name with a year or mail address.
_NAMED = r"(?-i:(?:\p{Lu}[^\s]*[\s,]+){1,5}(?:[12][0-9]{3}|<[^\s>]+@))"
_MARKER = (r"(?:copyright[^\p{L}\p{N}]*(?:c[^\p{L}]|©|[0-9]|by )|©|"
           r"\(c\)(?=[^\p{L}\p{N}]*(?:copyright|[12][0-9]{3})|\s*" + _NAMED + "))")
# A holder ends at the end of a sentence, which is not that of an initial or of "Inc." before more of the name, or
# where a licence begins without one.
_ABBREVIATED = r"(?<=\b(?:inc|ltd|corp|co|llc|gmbh|jr|sr)\.)(?=\s+(?-i:[^\p{Lu}\s]))"
_SENTENCE_END = r"(?<!(?<!\p{L})\p{L})\.(?=\s|\z)(?!" + _ABBREVIATED + ")"
_LICENCE_START = (r"(?=[\s,;:(-]+(?:permission (?:is|to)|everyone is permitted|redistribution and use|all rights reserved|"
                  r"(?:is )?(?:licensed|released|distributed|published) under|this (?:software|program|library|work|file|"
                  r"code|project|source|product|package) |spdx-license-identifier|(?:copyright|©)[^\p{L}\p{N}]*(?:\(c\)|©|[0-9]))|\s+\(c\)\s*[12][0-9]{3})")
COPYRIGHT_STATEMENT = (r"(?is)^(?:[^\p{L}\p{N}©(]*(?:all rights reserved|" + _MARKER
                       + ".*?(?:" + _SENTENCE_END + "|" + _LICENCE_START + r"|\z)))++")
# What the SQL twin drops: whole lines that start so.  The given tables have no other words on them.  The twin
# knows ``listed`` licences only.
COPYRIGHT_LINE = (r"^[^\p{L}\p{N}©(]*(copyright[^\p{L}\p{N}]*(c[^\p{L}]|[0-9]|by )|©|\(c\)|all rights reserved)")
NOT_WORD = r"[^\p{L}\p{N}]+"
# Spellings that count as one, applied in this order to words with single blanks between.
SPELLINGS = [("licenc", "licens"), ("organis", "organiz"), ("utilis", "utiliz"), ("recognis", "recogniz"),
             ("authoris", "authoriz"), ("favour", "favor"), ("honour", "honor"), ("behaviour", "behavior"),
             ("acknowledgement", "acknowledgment"), ("judgement", "judgment"), ("wilful", "willful"),
             ("whilst", "while"), ("per cent", "percent"), ("sub licens", "sublicens"),
             ("non commercial", "noncommercial"), ("non infring", "noninfring"),
             ("copyright owner", "copyright holder"), ("http www", "https www")]


def _spelled(text: Column) -> Column:
    for variant, form in SPELLINGS:
        text = F.replace(text, F.lit(variant), F.lit(form))
    return text


def _clean_lines(text: Column) -> Column:
    """Words of every line with single blanks between, without copyright statements at its start."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(lines, lambda line: F.trim(F.regexp_replace(
        F.lower(F.regexp_replace(line, COPYRIGHT_STATEMENT, "")), NOT_WORD, " ")))


def _digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def _whole(lines: Column) -> Column:
    return _spelled(F.array_join(F.filter(lines, lambda line: line != ""), " "))


def canonical(text: Column) -> Column:
    return F.transform(F.array(_clean_lines(text)), _whole)[0]


def digests(licenses: DataFrame) -> DataFrame:
    """``(digest, license_id)``, one row per digest: the smallest id if texts agree.

    Licences without a word, null ones among them, would match every empty text and are left out.
    """
    named = licenses.select("license_id", canonical(F.col("text")).alias("canonical")).filter("canonical <> ''")
    return named.groupBy(_digest(F.col("canonical")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """``(doc_id, scope, line_no, digest, license_id)``: for every row of ``docs`` one row with scope
    ``text``, whose license_id is null if the entire text is no known licence, and one row with scope
    ``line`` for every line (from 1) that is a known notice.

    Null and empty texts give the digest of the empty string and no licence.  Repeated rows give
    repeated results.  The digests are a written table, so Spark knows their size and broadcasts them only
    if they are small; in an exchange a hot digest is a skewed left side of rows with no text, which
    Spark can split.
    """
    known_digests = materialise(digests(licenses), "licenses")
    lines = docs.select("doc_id", _clean_lines(F.col("text")).alias("lines"))
    units = F.concat(
        F.array(F.struct(F.lit("text").alias("scope"), F.lit(0).alias("line_no"), _whole(F.col("lines")).alias("words"))),
        F.transform("lines", lambda line, i: F.struct(F.lit("line").alias("scope"), (i + 1).alias("line_no"),
                                                      _spelled(line).alias("words"))))
    each = lines.select("doc_id", F.inline(units)).filter("scope = 'text' or words <> ''")
    each = each.select("doc_id", "scope", "line_no", _digest(F.col("words")).alias("digest"))
    return (each.join(known_digests, "digest", "left").filter("scope = 'text' or license_id is not null")
            .select("doc_id", "scope", "line_no", "digest", "license_id"))


def known_licenses(spark: SparkSession) -> DataFrame:
    """The built-in licences; pass another ``(license_id, text)`` table for more."""
    return spark.createDataFrame(known(), "license_id string, text string").coalesce(1)


def op1_licenses(spark, sf_dir):
    """All documents against the built-in licences."""
    return scan(table(spark, sf_dir, "documents"), known_licenses(spark))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_spelled(column: str) -> str:
    for variant, form in SPELLINGS:
        column = f"replace({column}, {_sql_text(variant)}, {_sql_text(form)})"
    return column


def _sql_lines(text: str) -> str:
    return (f"list_transform(string_split(lower(coalesce({text}, '')), chr(10)), lambda l: CASE WHEN "
            f"regexp_matches(l, {_sql_text(COPYRIGHT_LINE)}) THEN '' ELSE trim(regexp_replace(l, {_sql_text(NOT_WORD)}, ' ', 'g')) END)")


_SQL_WHOLE = _sql_spelled("array_to_string(list_filter(lines, lambda l: l <> ''), ' ')")
OP1_SQL = f"""
WITH lined AS (SELECT doc_id, {_sql_lines('text')} AS lines FROM documents),
known AS (
    SELECT sha256({_SQL_WHOLE}) AS digest, min(license_id) AS license_id
    FROM (SELECT license_id, {_sql_lines('text')} AS lines
          FROM (VALUES {', '.join(f'({_sql_text(i)}, {_sql_text(t)})' for i, t in listed())}) k(license_id, text))
    WHERE {_SQL_WHOLE} <> '' GROUP BY 1),
units AS (
    SELECT doc_id, 'text' AS scope, 0 AS line_no, {_SQL_WHOLE} AS words FROM lined
    UNION ALL
    SELECT doc_id, 'line', line_no::INTEGER, {_sql_spelled('line')}
    FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM lined) WHERE line <> '')
SELECT doc_id, scope, line_no, sha256(words) AS digest, license_id
FROM (SELECT *, sha256(words) AS digest FROM units) u LEFT JOIN known USING (digest)
WHERE scope = 'text' OR license_id IS NOT NULL
"""
