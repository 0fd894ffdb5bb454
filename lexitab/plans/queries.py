"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexitab.functions import text
from lexitab.operators import index, lookup, merge, ordering, reports, routed
from lexitab.plans import build, fixtures, ranged
from lexitab.session import materialise, scratch_path
from lexitab.sinks.files import write_csv_parts
from lexitab.sources import synthetic
from lexitab.sources.files import read_dictionary, read_lines
from lexitab.sources.records import read_split_dictionary
from lexitab.streaming.changelog import apply_changelogs

PREFIX, TOP_K, PREFIX_LEN, SHARDS, VALUE_SEED = "th", 20, 4, 16, 5


def _inputs(spark: SparkSession, sf_dir: str, titles_only: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Existing rows, changelog and requests, from one written dictionary table."""
    t = fixtures.title_table(spark, sf_dir) if titles_only else fixtures.dictionary_table(spark, sf_dir)
    return (fixtures.existing(t), fixtures.changelog(t),
            fixtures.requests(t, fixtures.table(spark, sf_dir, "events")))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, changelog, _ = _inputs(spark, sf_dir)
    return merge.upsert(existing, changelog)


def _slim_table(rows: DataFrame, *extra: str) -> DataFrame:
    """Sorted rows as a written table that has their byte lengths in place of their values."""
    return index.data_table(rows, lambda df: materialise(
        df.select("title", "k", "byte_length", "pid", "row", *extra), "slim"))


def _merged_table(existing: DataFrame, changelog: DataFrame) -> DataFrame:
    return _slim_table(merge.upsert(existing, changelog, ordered=True), "status")


def _dictionary_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slim_table(ordering.stable_sort(fixtures.dictionary_table(spark, sf_dir)))


def _dictionary_csv(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    rows = ordering.stable_sort(fixtures.dictionary_table(spark, sf_dir))
    table = index.data_table(rows, lambda df: materialise(df, "dictionary"))
    path = scratch_path(spark, "csv")
    write_csv_parts(table, path)
    return table, path


def upsert_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: merge a changelog, sort, and index the result."""
    existing, changelog, _ = _inputs(spark, sf_dir)
    return (index.build_index(_merged_table(existing, changelog), "status")
            .select("title", "status", "byte_offset", "byte_length"))


def dict_scan(spark, sf_dir):
    return fixtures.dictionary(spark, sf_dir).select("ord", "title", "value")


def csv_round_trip(spark, sf_dir):
    _, path = _dictionary_csv(spark, sf_dir)
    return read_dictionary(spark, path, header=False).select("title", "value")


def csv_multiline_scan(spark, sf_dir):
    """Raw texts, line ends and all, written as CSV and read back in splits; each file has its header."""
    docs, path = fixtures.table(spark, sf_dir, "documents"), scratch_path(spark, "raw")
    docs.select(F.col("text").alias("value"), F.col("doc_id").cast("string").alias("title")).write.options(
        header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_split_dictionary(spark, path).select(F.col("title").cast("bigint").alias("doc_id"), "value")


def csv_exact_scan(spark, sf_dir):
    """Raw texts in a CSV that quotes a field only where a reader needs it: others hold lone quotes."""
    docs, path = fixtures.table(spark, sf_dir, "documents"), scratch_path(spark, "raw")
    body = F.coalesce("text", F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(body, F.lit('"'), F.lit('""')), F.lit('"'))
    field = F.when(body.rlike(r'^"|[,\r\n]'), quoted).otherwise(body)
    docs.select(F.concat(F.col("doc_id").cast("string"), F.lit('" x,'), field).alias("line")).write.option("lineSep", "\r\n").text(path)
    return read_split_dictionary(spark, path, header=False).select("title", "value")


def title_fold(spark, sf_dir):
    return fixtures.dictionary(spark, sf_dir).select("ord", "title", text.fold("title").alias("k"))


def title_case(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "part").select(
        "p_partkey", text.capitalize("p_type").alias("capital"), text.capitalize("p_name").alias("name"),
        F.lower("p_type").alias("lower"), F.upper("p_name").alias("upper"))


def normalize_text(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", text.normalize("text").alias("value"))


def row_bytes(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.csv_line("source", "text").alias("line"),
                       text.row_bytes("source", "text").alias("byte_length"))


def version_stamp(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", text.date_stamp("ts").alias("version"), text.iso_stamp("ts").alias("last_updated_at"))


def upsert_merge(spark, sf_dir):
    return _merged(spark, sf_dir).select("title", "value", "status")


def changelog_new_rows(spark, sf_dir):
    return merge.added_rows(_merged(spark, sf_dir)).select("title", "value")


def changelog_updates(spark, sf_dir):
    return merge.updated_rows(_merged(spark, sf_dir)).select("title", "value")


def existing_untouched_rows(spark, sf_dir):
    return merge.untouched_rows(_merged(spark, sf_dir)).select("title", "value")


def merge_stats(spark, sf_dir):
    t = fixtures.dictionary(spark, sf_dir)
    return merge.merge_stats(fixtures.existing(t), fixtures.changelog(t))


def sorted_dictionary(spark, sf_dir):
    return ordering.sorted_table(fixtures.dictionary_table(spark, sf_dir)).select("pos", "title", "value")


def dedupe_first(spark, sf_dir):
    return ordering.distinct_first(fixtures.dictionary(spark, sf_dir)).select("ord", "title", "value")


def unique_limit(spark, sf_dir):
    """Half as many unique titles as there are documents, first come first kept."""
    half = fixtures.table(spark, sf_dir, "documents").count() // 2
    unique = ordering.distinct_first(fixtures.dictionary(spark, sf_dir))
    return ordering.first_n(unique, half).select("ord", "title", "value")


def build_index(spark, sf_dir):
    return (index.build_index(_dictionary_slim(spark, sf_dir))
            .select("title", "byte_offset", "byte_length"))


def index_last_wins(spark, sf_dir):
    return (index.last_wins(index.build_index(_dictionary_slim(spark, sf_dir)))
            .select("title", "byte_offset", "byte_length"))


def index_validation(spark, sf_dir):
    existing, changelog, _ = _inputs(spark, sf_dir, titles_only=True)
    return index.index_validation(merge.upsert(existing, changelog))


def index_from_lines(spark, sf_dir):
    _, path = _dictionary_csv(spark, sf_dir)
    lines = read_lines(spark, path)
    return index.last_wins(index.logical_offsets(index.index_lines(lines, header=False), path))


def line_counts(spark, sf_dir):
    """Physical lines of a CSV of raw texts: continuation lines count, blank ones are skipped."""
    docs = fixtures.table(spark, sf_dir, "documents")
    path = scratch_path(spark, "raw")
    docs.select(text.csv_line("source", "text").alias("line")).write.option("lineSep", "\r\n").text(path)
    return index.line_counts(read_lines(spark, path))


def index_slice_audit(spark, sf_dir):
    table, path = _dictionary_csv(spark, sf_dir)
    return lookup.fetch_slices(spark, index.build_index(table), path)


def index_shards(spark, sf_dir):
    return index.index_shards(_dictionary_slim(spark, sf_dir), SHARDS)


def size_report(spark, sf_dir):
    return reports.size_report(fixtures.dictionary(spark, sf_dir))


def capacity_estimate(spark, sf_dir):
    slim = _dictionary_slim(spark, sf_dir)
    return reports.capacity_estimate(fixtures.dictionary(spark, sf_dir), index.last_wins(index.build_index(slim)))


def hot_keys(spark, sf_dir):
    return reports.hot_keys(_inputs(spark, sf_dir, titles_only=True)[2], TOP_K)


def batch_lookup(spark, sf_dir):
    existing, changelog, requests = _inputs(spark, sf_dir)
    table = lookup.latest_values(merge.upsert(existing, changelog))
    return lookup.lookup(requests, table).select("request_id", "key", "found", "value")


def index_lookup(spark, sf_dir):
    existing, changelog, requests = _inputs(spark, sf_dir)
    entries = index.last_wins(index.build_index(_merged_table(existing, changelog)))
    return lookup.lookup(requests, entries).select("request_id", "key", "found", "byte_offset", "byte_length")


def _routed_index(spark, sf_dir) -> tuple[str, DataFrame]:
    """The index of the merged table as shards, and the requests."""
    existing, changelog, requests = _inputs(spark, sf_dir)
    path = scratch_path(spark, "routed")
    routed.write_routed(index.last_wins(index.build_index(_merged_table(existing, changelog))).select(
        "title", "byte_offset", "byte_length"), path, SHARDS)
    return path, requests


def routed_lookup(spark, sf_dir):
    """The requests once more, from the shards that their keys fall into."""
    path, requests = _routed_index(spark, sf_dir)
    return routed.routed_lookup(requests, path).select("request_id", "key", "found", "byte_offset", "byte_length")


def known_key_lookup(spark, sf_dir):
    """The most requested keys, put into the scan of the sharded index."""
    path, requests = _routed_index(spark, sf_dir)
    hot = reports.hot_keys(requests, TOP_K)
    return routed.find(spark, path, [r.key for r in hot.collect()])


def lookup_misses(spark, sf_dir):
    existing, changelog, requests = _inputs(spark, sf_dir, titles_only=True)
    return lookup.misses(requests, merge.upsert(existing, changelog))


def prefix_search(spark, sf_dir):
    return lookup.prefix_search(fixtures.dictionary(spark, sf_dir), PREFIX, TOP_K)


def prefix_index_topk(spark, sf_dir):
    return lookup.prefix_index(fixtures.dictionary(spark, sf_dir), PREFIX_LEN, 3)


def prefix_complete(spark, sf_dir):
    t = fixtures.title_table(spark, sf_dir)
    requests = fixtures.requests(t, fixtures.table(spark, sf_dir, "events"))
    asked = requests.select("request_id", F.substring("key", 1, 3).alias("prefix"))
    return (lookup.complete(asked, lookup.prefix_index(t, PREFIX_LEN, 3))
            .select("request_id", "prefix", "rank", "title"))


def _synthetic(spark, sf_dir, seed: int, templates: list[str]) -> DataFrame:
    """A synthetic row for every document, in the most frequent words of all documents.

    A block has one attempt per document; making titles is heavy for such slim rows, so they are spread
    over all cores first.
    """
    docs = fixtures.table(spark, sf_dir, "documents")
    ids, n = docs.select("doc_id").repartition(spark.sparkContext.defaultParallelism, "doc_id"), docs.count()

    def block(i: int) -> DataFrame:
        return ids.select((F.col("doc_id") + i * n).alias("attempt"))
    return synthetic.from_attempts(block, n, seed, templates, synthetic.frequent_words(docs))


def synth_dictionary(spark, sf_dir):
    return _synthetic(spark, sf_dir, 7, synthetic.FULL_TEMPLATES)


def synth_values(spark, sf_dir):
    """The generated value of every document's number, in the most frequent words of all documents."""
    docs = fixtures.table(spark, sf_dir, "documents")
    words, attempt = synthetic.frequent_words(docs), F.col("doc_id")
    ids = docs.select("doc_id").repartition(spark.sparkContext.defaultParallelism, "doc_id")
    return ids.select("doc_id", synthetic.value(attempt, VALUE_SEED, synthetic.target_bytes(attempt, VALUE_SEED), words).alias("value"))


def synth_checks(spark, sf_dir):
    """Counts that must hold for any seed: all rows made, none a copy, short or split."""
    rows = _synthetic(spark, sf_dir, 11, synthetic.SMALL_TEMPLATES)
    target = synthetic.target_bytes(F.col("ord"), 11)
    short = F.count_if(text.utf8_bytes("value") < target)
    per_title = rows.groupBy("title").agg(
        F.count(F.lit(1)).alias("n"), short.alias("short"), F.count_if(F.col("value").rlike(r"[\r\n]")).alias("split"))
    return per_title.agg(F.sum("n").alias("total_rows"), F.sum(F.col("n") - 1).alias("copies"),
                         F.sum("short").alias("short_values"), F.sum("split").alias("split_values"))


def _published(spark, sf_dir, inputs: tuple[DataFrame, DataFrame, DataFrame] | None = None, **options) -> str:
    """A root with a full build of E and a same-day incremental build with C."""
    root, day = scratch_path(spark, "published"), datetime(2024, 5, 1)
    existing, changelog, _ = inputs or _inputs(spark, sf_dir)
    build.full_build(spark, root, existing, now=day, csv=False)
    build.incremental_build(spark, root, _as_csv_order(changelog), now=day, **options)
    return root


def published_dictionary(spark, sf_dir):
    """Both builds, read back through the manifest."""
    return (index.build_index(build.live_data(spark, _published(spark, sf_dir, csv=False)), "value")
            .select("title", "value", "byte_offset", "byte_length"))


def published_index(spark, sf_dir):
    return (build.live_index(spark, _published(spark, sf_dir, csv=False))
            .select("title", "byte_offset", "byte_length"))


def published_index_json(spark, sf_dir):
    return build.live_index_json(spark, _published(spark, sf_dir, csv=False, index_json=True))


def published_audit(spark, sf_dir):
    """What the published CSV parts and both forms of the index hold, read back, and how many are damaged."""
    parts = build.audit(spark, _published(spark, sf_dir, index_json=True))
    return parts.groupBy("kind").agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"),
                                     F.count_if("damaged").alias("damaged"))


def _updated(spark, sf_dir) -> str:
    """A root with E as a copy-on-write version, updated by C."""
    root, day = scratch_path(spark, "ranged"), datetime(2024, 5, 1)
    existing, changelog, _ = _inputs(spark, sf_dir)
    ranged.create(spark, root, existing, now=day)
    ranged.update(spark, root, _as_csv_order(changelog), now=day)
    return root


def incremental_touched_files(spark, sf_dir):
    """The upsert again, by rewriting only the files that the changelog meets."""
    return ranged.rows(spark, _updated(spark, sf_dir)).select("title", "value")


def two_level_index(spark, sf_dir):
    """Offsets after that update: entries inside their files, files inside the whole."""
    return ranged.index(spark, _updated(spark, sf_dir))


def range_lookup(spark, sf_dir):
    """The requests again, answered from byte ranges of the published CSV parts."""
    inputs = _inputs(spark, sf_dir)
    root = _published(spark, sf_dir, inputs)
    return (lookup.read_values(spark, inputs[2], build.live_index(spark, root), build.live_csv(spark, root))
            .select("request_id", "key", "found", "value"))


def _drop_changelog(spark, rows: DataFrame, incoming: str, name: str) -> None:
    """Put a changelog down as a folder of CSV files, in its own order."""
    ordered = ordering.range_sort(rows, ["ord"])
    ordered.select("value", "title").write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{incoming}/{name}")


def streamed_changelog(spark, sf_dir):
    """The same upsert, with C arriving as CSV files whose columns are the other way round."""
    root, incoming = scratch_path(spark, "streamed"), scratch_path(spark, "incoming")
    existing, changelog, _ = _inputs(spark, sf_dir)
    build.full_build(spark, root, existing, csv=False)
    _drop_changelog(spark, changelog, incoming, "c1")
    apply_changelogs(spark, root, incoming, csv=False).awaitTermination()
    return build.live_data(spark, root).select("title", "value")


def streamed_two_changelogs(spark, sf_dir):
    """C and then a second changelog on the same keys, both waiting in one batch."""
    root, incoming = scratch_path(spark, "streamed"), scratch_path(spark, "incoming")
    existing, changelog, _ = _inputs(spark, sf_dir)
    build.full_build(spark, root, existing, csv=False)
    _drop_changelog(spark, fixtures.second_changelog(changelog), incoming, "c2")
    _drop_changelog(spark, changelog, incoming, "c1")
    apply_changelogs(spark, root, incoming, csv=False).awaitTermination()
    return build.live_data(spark, root).select("title", "value")


def _as_csv_order(rows: DataFrame) -> DataFrame:
    """Give rows from a table the kind of ``ord`` that CSV input has."""
    return rows.withColumn("ord", F.struct(
        F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), F.col("ord").alias("row")))


QUERIES = {f.__name__: f for f in (
    upsert_index, dict_scan, csv_round_trip, csv_multiline_scan, csv_exact_scan, title_fold, title_case, normalize_text, row_bytes,
    version_stamp, upsert_merge, changelog_new_rows, changelog_updates, existing_untouched_rows,
    merge_stats, sorted_dictionary, dedupe_first, unique_limit, build_index, index_last_wins,
    index_validation, index_from_lines, line_counts, index_slice_audit, index_shards, size_report,
    capacity_estimate, hot_keys, batch_lookup, index_lookup, routed_lookup, known_key_lookup, lookup_misses, prefix_search,
    prefix_index_topk, prefix_complete, synth_dictionary, synth_values, synth_checks, published_dictionary,
    published_index, published_index_json, published_audit, incremental_touched_files, two_level_index, range_lookup, streamed_changelog, streamed_two_changelogs,
)}
