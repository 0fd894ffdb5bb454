"""Rendezvous sharding of stable record keys over weighted shards (DataFrame functions only).

Every shard draws a number for every key, and the shard with the best draw takes the record.  A new
shard only takes the records whose best draw is its own: no record moves between old shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexitab.operators.columns import packed, unused
from lexitab.operators.ordering import number_rows, range_sort, with_positions
from lexitab.plans.fixtures import table
from lexitab.session import materialise

SHARDS = 16
# A draw is the first 13 hexadecimal digits of an MD5, so that any engine can repeat it.
DRAW_DIGITS = 13


def draw(key: Column, shard: int, weight: float) -> Column:
    """The score of a key in a shard: ``-weight / ln(u)`` with ``u`` uniform in (0, 1).

    The chance to have the highest score is in proportion to the weight.
    """
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, DRAW_DIGITS)
    u = (F.conv(digits, 16, 10).cast("long") + 0.5) / float(16 ** DRAW_DIGITS)
    return F.lit(-float(weight)) / F.ln(u)


def _best(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """The best ``(score, shard)`` over shards ``first..``; the lower shard wins a tie."""
    draws = [F.struct(draw(key, first + i, w).alias("score"), F.lit(-(first + i)).alias("shard"))
             for i, w in enumerate(weights)]
    return draws[0] if len(draws) == 1 else F.greatest(*draws)


def rendezvous(df: DataFrame, key: str, weights: Sequence[float], added: Sequence[float] = ()) -> DataFrame:
    """Add ``shard`` for shards of the given weights and ``grown_shard`` for those plus ``added``.

    The key alone decides, so equal keys meet in one shard; a null key counts as the empty key.
    Zero rows give zero rows.  Columns named ``shard`` or ``grown_shard`` are replaced.
    """
    if not weights or min([*weights, *added]) <= 0:
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    old, new = unused(df, "_old"), unused(df, "_new")
    df = df.withColumn(old, _best(text, weights))
    grown = F.greatest(old, _best(text, added, len(weights))) if added else F.col(old)
    df = df.withColumn(new, grown)
    return (df.withColumns({"shard": -F.col(f"{old}.shard"), "grown_shard": -F.col(f"{new}.shard")})
            .drop(old, new))


def with_slots(sharded: DataFrame, order: Sequence[str]) -> DataFrame:
    """Number the rows of every shard from 0 without a gap, in the given order.

    One range exchange cuts anywhere, also inside a shard or a repeated key, so no shard has to fit
    one task; only one count per partition and one start per shard are put together.
    Rows that agree in ``order`` are numbered in any order.  A column named ``slot`` is replaced.
    """
    rows = sharded.drop("slot")
    unique = rows.select(packed(rows), F.col("shard"), F.monotonically_increasing_id().alias("nth"))
    placed = materialise(number_rows(range_sort(unique, ["shard", *(f"data.{c}" for c in order), "nth"])), "shards")
    positions = with_positions(placed)
    starts = positions.groupBy("shard").agg(F.min("pos").alias("first"))
    return positions.join(starts, "shard").select("data.*", (F.col("pos") - F.col("first")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, weights: Sequence[float], added: Sequence[float]) -> DataFrame:
    """Shards, sizes and checksums of ``(doc_id, text)`` rows; the text itself is not moved.

    ``size`` is the UTF-8 bytes of the text plus 1.  A null text has no bytes and the checksum 0,
    like an empty one.  Repeated rows each get a slot of their own.
    """
    slim = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    sharded = rendezvous(slim, "doc_id", weights, added).withColumn("law", F.lit("key"))
    return with_slots(sharded, ["doc_id", "text_crc32", "size"])


def op2_sharding(spark, sf_dir):
    """All documents over 16 equal shards, and over 17."""
    return shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


OP2_SQL = """
WITH crc AS (
    SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::UBIGINT, range(8)::UBIGINT[]),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t),
hexed AS (
    SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS x
    FROM documents),
bytes AS (
    SELECT doc_id, size, list_transform(range(length(x) // 2),
        lambda i: (instr('123456789ABCDEF', x[2 * i + 1]) * 16 + instr('123456789ABCDEF', x[2 * i + 2]))::UBIGINT) AS b
    FROM hexed),
sums AS (
    SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::UBIGINT, b),
        lambda c, v: xor(c >> 8, t[((xor(c, v) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) AS text_crc32
    FROM bytes, crc),
draws AS (
    SELECT doc_id, s, -1.0::DOUBLE / ln((('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || s)[1:13])::BIGINT + 0.5)
        / 4503599627370496.0::DOUBLE) AS score
    FROM (SELECT DISTINCT doc_id FROM documents), range(17) r(s)),
best AS (
    SELECT doc_id, arg_max(s, score) FILTER (s < 16) AS shard, arg_max(s, score) AS grown_shard
    FROM draws GROUP BY doc_id)
SELECT d.doc_id, d.size::BIGINT AS size, d.text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
    grown_shard::INTEGER AS grown_shard
FROM sums d JOIN best b ON d.doc_id IS NOT DISTINCT FROM b.doc_id
"""
