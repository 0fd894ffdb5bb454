"""The same results in SQL, stated independently: pairing by a full outer join, global windows."""

from __future__ import annotations

from lexitab.plans.queries import PREFIX, PREFIX_LEN, SHARDS, TOP_K, VALUE_SEED

_SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def _clean(column: str) -> str:
    return f"trim(regexp_replace({column}, '{_SPACE}', ' ', 'g'))"


def _field(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '[,"\\r\\n]') THEN '"' || replace({x}, '"', '""') || '"' ELSE {x} END"""


def _bytes(title: str = "title", value: str = "value") -> str:
    return f"CAST(octet_length(encode({_field(title)})) + octet_length(encode({_field(value)})) + 3 AS INTEGER)"


_T = f"""
t AS (
  SELECT ord, value, CASE WHEN ord % 2 = 0 THEN lower(w) ELSE w END AS title
  FROM (SELECT doc_id AS ord, value, array_to_string(list_slice(string_split(value, ' '), 1, 2), ' ') AS w
        FROM (SELECT doc_id, {_clean('text')} AS value FROM documents)
        WHERE value <> ''))"""

_MERGE = _T + """,
e AS (SELECT *, lower(title) AS k, row_number() OVER (PARTITION BY lower(title) ORDER BY ord) AS rn
      FROM t WHERE ord % 4 <> 0),
c AS (SELECT *, lower(title) AS k, row_number() OVER (PARTITION BY lower(title) ORDER BY ord) AS rn
      FROM (SELECT ord, title, CASE WHEN ord % 8 = 1 THEN value || ' [rev2]' ELSE value END AS value
            FROM t WHERE ord % 4 = 0 OR ord % 8 = 1)),
m AS (SELECT coalesce(c.k, e.k) AS k, coalesce(c.rn, e.rn) AS rn,
             CASE WHEN c.title IS NULL THEN e.title ELSE c.title END AS title,
             CASE WHEN c.title IS NULL THEN e.value ELSE c.value END AS value,
             CASE WHEN c.title IS NULL THEN 'kept' WHEN e.title IS NULL THEN 'added' ELSE 'updated' END AS status
      FROM e FULL OUTER JOIN c ON e.k = c.k AND e.rn = c.rn)"""


def _index(name: str, source: str, order: str) -> str:
    """A CTE with every row of ``source`` and its offset in the single file."""
    return f""",
{name} AS (
  SELECT *, CAST(13 + coalesce(sum(byte_length) OVER (ORDER BY {order}
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset
  FROM (SELECT *, {_bytes()} AS byte_length FROM {source}))"""


def _last(name: str) -> str:
    return f"""SELECT title, max(byte_offset) AS byte_offset, arg_max(byte_length, byte_offset) AS byte_length
FROM {name} GROUP BY title"""


_MERGE_INDEX = _MERGE + _index("mi", "m", "k, rn")
_T_INDEX = _T + _index("ti", "t", "lower(title), ord")

_R = """,
r AS (SELECT event_id AS request_id, ts,
             CASE WHEN event_id % 10 = 0 THEN 'missing-' || event_id ELSE coalesce(t.title, 'missing-user') END AS key
      FROM events LEFT JOIN t ON t.ord = user_id)"""

_PREFIXES = f""",
p AS (SELECT * FROM (
  SELECT prefix, CAST(row_number() OVER (PARTITION BY prefix ORDER BY k, title) AS INTEGER) AS rank, title
  FROM (SELECT DISTINCT title, lower(title) AS k, left(lower(title), n) AS prefix
        FROM t, range(1, {PREFIX_LEN + 1}) AS lengths(n) WHERE length(title) >= n))
  WHERE rank <= 3)"""


def _with_status(status: str) -> str:
    return f"WITH {_MERGE} SELECT title, value FROM m WHERE status = '{status}'"


ORACLES = {
    "upsert_index": f"WITH {_MERGE_INDEX} SELECT title, status, byte_offset, byte_length FROM mi",
    "dict_scan": f"WITH {_T} SELECT ord, title, value FROM t",
    "csv_round_trip": f"WITH {_T} SELECT title, value FROM t",
    "csv_multiline_scan": r"""SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS value FROM documents""",
    "csv_exact_scan": r"""SELECT doc_id || '" x' AS title, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS value FROM documents""",
    "title_fold": f"WITH {_T} SELECT ord, title, lower(title) AS k FROM t",
    "title_case": """SELECT p_partkey, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS capital,
  upper(left(p_name, 1)) || lower(substr(p_name, 2)) AS name, lower(p_type) AS lower, upper(p_name) AS upper FROM part""",
    "normalize_text": f"SELECT doc_id, {_clean('text')} AS value FROM documents",
    "row_bytes": f"""SELECT doc_id, ({_field('source')}) || ',' || ({_field('text')}) AS line,
  {_bytes('source', 'text')} AS byte_length FROM documents""",
    "version_stamp": """SELECT event_id, strftime(ts, '%Y%m%d') AS version,
  CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS last_updated_at FROM events""",
    "upsert_merge": f"WITH {_MERGE} SELECT title, value, status FROM m",
    "changelog_new_rows": _with_status("added"),
    "changelog_updates": _with_status("updated"),
    "existing_untouched_rows": _with_status("kept"),
    "merge_stats": f"""WITH {_MERGE}
SELECT (SELECT count(*) FROM e) AS existing_count, (SELECT count(*) FROM c) AS changelog_count,
  count(*) FILTER (status = 'updated') AS updated_count, count(*) FILTER (status = 'added') AS added_count,
  count(*) AS total_count FROM m""",
    "sorted_dictionary": f"""WITH {_T}
SELECT row_number() OVER (ORDER BY lower(title), ord) - 1 AS pos, title, value FROM t""",
    "dedupe_first": f"""WITH {_T}
SELECT t.ord, t.title, t.value FROM t JOIN (SELECT title, min(ord) AS ord FROM t GROUP BY title) f USING (title, ord)""",
    "unique_limit": f"""WITH {_T}
SELECT ord, title, value FROM (
  SELECT *, row_number() OVER (ORDER BY ord) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ord) AS seen FROM t) WHERE seen = 1)
WHERE n <= (SELECT count(*) // 2 FROM documents)""",
    "build_index": f"WITH {_T_INDEX} SELECT title, byte_offset, byte_length FROM ti",
    "index_last_wins": f"WITH {_T_INDEX} {_last('ti')}",
    "index_validation": f"""WITH {_MERGE}
SELECT count(DISTINCT title) AS index_entries, count(*) AS total_rows, count(*) - count(DISTINCT title) AS difference FROM m""",
    "index_from_lines": f"WITH {_T_INDEX} {_last('ti')}",
    "line_counts": f"""WITH l AS (
  SELECT unnest(string_split(({_field('source')}) || ',' || ({_field('text')}) || chr(13), chr(10))) AS line FROM documents)
SELECT count(*) AS total_lines, count(*) FILTER (rtrim(line, chr(13)) <> '') AS indexed_lines,
  count(*) FILTER (rtrim(line, chr(13)) = '') AS skipped_lines, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS total_bytes FROM l""",
    "index_slice_audit": f"""WITH {_T_INDEX}
SELECT title, byte_offset, byte_length, title AS slice_title, value AS slice_value FROM ti""",
    "index_shards": f"""WITH {_T}
SELECT CAST(pos * {SHARDS} // (SELECT count(*) FROM t) AS INTEGER) AS shard, count(*) AS entries, min(k) AS min_key, max(k) AS max_key
FROM (SELECT lower(title) AS k, row_number() OVER (ORDER BY lower(title), ord) - 1 AS pos FROM t) GROUP BY shard""",
    "size_report": f"""WITH {_T}
SELECT *, data_bytes / 1048576.0::DOUBLE AS data_mb, data_bytes / 1073741824.0::DOUBLE AS data_gb
FROM (SELECT count(*) AS total_rows, CAST(sum({_bytes()}) + 13 AS BIGINT) AS data_bytes,
             CAST(sum(octet_length(encode(title))) AS BIGINT) AS title_bytes FROM t)""",
    "capacity_estimate": f"""WITH {_T_INDEX}, d AS ({_last('ti')})
SELECT *, (SELECT CAST(sum(octet_length(encode('  ' || to_json(title) || ': {{|    "offset": ' || byte_offset || ',|    "length": ' || byte_length || '|  }}|')))
    + count(*) - 1 + 4 AS BIGINT) FROM d) AS index_json_bytes, index_bytes + data_bytes AS version_bytes, 2 * (index_bytes + data_bytes) AS storage_bytes
FROM (SELECT count(*) AS keys, CAST(sum(octet_length(encode(title)) + 18) AS BIGINT) AS index_bytes,
             CAST(sum({_bytes()}) + 13 AS BIGINT) AS data_bytes FROM t)""",
    "hot_keys": f"""WITH {_T}{_R}
SELECT key, count(*) AS requests FROM r GROUP BY key ORDER BY requests DESC, key LIMIT {TOP_K}""",
    "batch_lookup": f"""WITH {_MERGE_INDEX}{_R},
d AS (SELECT title, arg_max(value, byte_offset) AS value FROM mi GROUP BY title)
SELECT request_id, key, d.title IS NOT NULL AS found, d.value FROM r LEFT JOIN d ON d.title = key""",
    "index_lookup": f"""WITH {_MERGE_INDEX}{_R}, d AS ({_last('mi')})
SELECT request_id, key, d.title IS NOT NULL AS found, byte_offset, byte_length FROM r LEFT JOIN d ON d.title = key""",
    "lookup_misses": f"""WITH {_MERGE}{_R}
SELECT key, count(*) AS requests FROM r WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.title = r.key) GROUP BY key""",
    "prefix_search": f"""WITH {_T}
SELECT title, value FROM t WHERE starts_with(lower(title), '{PREFIX}') ORDER BY lower(title), title, value LIMIT {TOP_K}""",
    "prefix_index_topk": f"WITH {_T}{_PREFIXES} SELECT prefix, rank, title FROM p",
    "prefix_complete": f"""WITH {_T}{_R}{_PREFIXES}
SELECT request_id, lower(left(key, 3)) AS prefix, rank, title FROM r LEFT JOIN p ON p.prefix = lower(left(key, 3))""",
    "synth_checks": """SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS copies,
  CAST(0 AS BIGINT) AS short_values, CAST(0 AS BIGINT) AS split_values FROM documents""",
    "published_dictionary": f"WITH {_MERGE_INDEX} SELECT title, value, byte_offset, byte_length FROM mi",
    "published_index": f"WITH {_MERGE_INDEX} {_last('mi')}",
    "streamed_changelog": f"WITH {_MERGE} SELECT title, value FROM m",
    "streamed_two_changelogs": f"""WITH {_MERGE},
d AS (SELECT upper(title) AS title, value || ' [rev3]' AS value, k, row_number() OVER (PARTITION BY k ORDER BY ord) AS n
      FROM c WHERE ord % 16 IN (0, 1)),
m1 AS (SELECT title, value, k, row_number() OVER (PARTITION BY k ORDER BY rn) AS n
       FROM (SELECT title, value, k, rn + CASE WHEN status = 'kept' THEN 1000000000 ELSE 0 END AS rn FROM m))
SELECT coalesce(d.title, m1.title) AS title, coalesce(d.value, m1.value) AS value
FROM m1 FULL OUTER JOIN d ON m1.k = d.k AND m1.n = d.n""",
}


def _key(use: int) -> str:
    first = f"((doc_id % 2147483647 + {(VALUE_SEED * 7368787 + use * 15485863) % 2147483647}) % 2147483647)"
    second = f"(({first} * {first} + 99991) % 2147483647)"
    return f"(({second} * {second} + doc_id + {use}) % 2147483647)"


ORACLES["synth_values"] = f"""
WITH vocabulary AS (
  SELECT w, row_number() OVER (ORDER BY n DESC, w) - 1 AS i FROM (
    SELECT w, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}]+')) AS w FROM documents)
    WHERE length(w) >= 3 GROUP BY w ORDER BY n DESC, w LIMIT 2048)),
known AS (SELECT count(*) AS size, min(octet_length(encode(w))) AS shortest FROM vocabulary),
keys AS (SELECT doc_id, {_key(1)} AS k, {_key(2)} % 7001 + 5000 AS target FROM documents),
x1 AS (SELECT doc_id, k, target, size, unnest(range(1, CAST(ceil(target / (shortest + 1)) AS BIGINT) + 25)) AS j FROM keys, known),
x2 AS (SELECT *, (k + j * 104729) % 2147483647 AS x FROM x1),
x3 AS (SELECT * REPLACE ((x * x + k) % 2147483647 AS x) FROM x2),
x4 AS (SELECT * REPLACE ((x * x + 104729) % 2147483647 AS x) FROM x3),
drawn AS (SELECT doc_id, target, j, w, x // size AS rest, (x // size) % 9 = 0 OR j % 24 = 0 AS ends,
    sum(octet_length(encode(w)) + 1) OVER (PARTITION BY doc_id ORDER BY j) AS bytes, FROM x4 JOIN vocabulary ON i = x % size),
stops AS (SELECT doc_id, min(j) AS stop FROM drawn WHERE ends AND bytes >= target GROUP BY doc_id),
shown AS (
  SELECT doc_id, j, CASE WHEN coalesce(lag(ends) OVER (PARTITION BY doc_id ORDER BY j), true) THEN upper(w[1]) || lower(w[2:]) ELSE w END
    || CASE WHEN ends THEN ['.', '.', '.', '?', '.', '!', '.'][(rest // 9) % 7 + 1] ELSE '' END AS t
  FROM drawn JOIN stops USING (doc_id) WHERE j <= stop)
SELECT doc_id, string_agg(t, ' ' ORDER BY j) AS value FROM shown GROUP BY doc_id
"""
ORACLES["routed_lookup"] = ORACLES["index_lookup"]
ORACLES["known_key_lookup"] = f"""WITH {_MERGE_INDEX}{_R}, d AS ({_last('mi')})
SELECT title, byte_offset, byte_length FROM d
WHERE title IN (SELECT key FROM r GROUP BY key ORDER BY count(*) DESC, key LIMIT {TOP_K})"""
ORACLES["range_lookup"] = ORACLES["batch_lookup"]
ORACLES["incremental_touched_files"] = ORACLES["streamed_changelog"]
ORACLES["two_level_index"] = f"WITH {_MERGE_INDEX} SELECT title, byte_offset, byte_length FROM mi"
ORACLES["published_index_json"] = ORACLES["published_index"]
ORACLES["published_audit"] = f"""WITH {_MERGE_INDEX}, d AS ({_last('mi')})
SELECT 'data.csv' AS kind, count(*) AS lines, CAST(sum(byte_length) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS damaged FROM mi
UNION ALL SELECT kind, count(*), CAST(sum(byte_length) AS BIGINT), CAST(0 AS BIGINT)
FROM d, (VALUES ('index.parquet'), ('index.json')) AS kinds(kind) GROUP BY kind"""
