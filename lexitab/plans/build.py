"""Full and incremental builds: write a new version, verify it, then switch the manifest."""

from __future__ import annotations

import os
import warnings
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexitab.functions.text import date_stamp, iso_stamp
from lexitab.operators.audit import compare, due_parts, entries_digest, found_parts
from lexitab.operators.index import PART_ROWS, build_index, data_table, last_wins
from lexitab.operators.merge import upsert
from lexitab.operators.ordering import range_sort, stable_sort
from lexitab.operators.reports import json_index_bytes
from lexitab.schema import DICT, HEADER_BYTES
from lexitab.session import materialise, write_table
from lexitab.sinks.files import (children, create_once, exists, write_csv_header, write_csv_parts, write_index, write_index_json,
                                 write_manifest)
from lexitab.sources.files import (as_dictionary, read_data, read_dictionary, read_index, read_index_json,
                                   read_manifest, read_part_lines)
from lexitab.sources.listing import listed_bytes
from lexitab.sources.synthetic import FULL_TEMPLATES, generate

MANIFEST_FILE = "manifest.json"
DATA, CSV, INDEX, INDEX_JSON, DIGESTS = "data.parquet", "data.csv", "index.parquet", "index.json", "digests.parquet"
VERSIONS, CLAIMS = "dict", "_claims"
DEFAULT_GB = 5.0
# Damaged parts that an error names.
SHOWN = 5


@dataclass
class Version:
    """What a build published."""

    version: str
    file_path: str
    index_file_path: str
    rows: int
    index_entries: int
    data_bytes: int
    index_bytes: int
    index_json_bytes: int | None = None
    counters: dict[str, int] | None = None


def load_manifest(spark: SparkSession, root: str) -> dict[str, str]:
    row = read_manifest(spark, os.path.join(root, MANIFEST_FILE)).first()
    return {} if row is None else {k: v for k, v in row.asDict().items() if v is not None}


def stamps(spark: SparkSession, now: datetime | None) -> tuple[str, str]:
    ts = F.current_timestamp() if now is None else F.lit(now)
    return tuple(spark.range(1).select(date_stamp(ts), iso_stamp(ts)).first())


def claim_version(spark: SparkSession, root: str, stamp: str) -> str:
    """``stamp``, or ``stamp-n`` on a day that already has a version: versions are immutable.

    A claim is a small object that only one build can create, so two builds at once never share a name.
    """
    version, n = stamp, 0
    while exists(spark, os.path.join(root, VERSIONS, version)) or not create_once(
            spark, os.path.join(root, CLAIMS, version), stamp):
        n += 1
        version = f"{stamp}-{n}"
    return version


def switch_manifest(spark: SparkSession, path: str, manifest: dict[str, str], seen: dict[str, str]) -> None:
    """Replace the manifest if it still is the one this build started from.

    So of two builds from one version the later one is refused, in place of dropping the other's update;
    its version stays unused.  Comparing and replacing are two steps of a moment, not one.
    """
    if load_manifest(spark, os.path.dirname(path)) != seen:
        raise RuntimeError("the manifest was changed by another build: start again from its version")
    write_manifest(spark, path, manifest)


def _publish(spark: SparkSession, root: str, version: str, ordered: DataFrame, *,
             part_rows: int, csv: bool, index_json: bool, strict: bool) -> Version:
    """Write data, index and CSV parts below ``dict/<version>`` and check them against each other.

    The data table is the one full-size write; the index and the CSV parts are made from it, so
    they agree on every row's place also when tasks run again.
    """
    home = os.path.join(root, VERSIONS, version)
    data = data_table(ordered, lambda df: write_table(df, os.path.join(home, DATA)))
    entries = write_index(last_wins(build_index(data, part_rows=part_rows)), os.path.join(home, INDEX))
    if index_json:
        write_index_json(entries, os.path.join(home, INDEX_JSON))
    if csv:
        write_csv_header(spark, os.path.join(home, "header.csv"))
        write_csv_parts(data, os.path.join(home, CSV), part_rows)
    due = entries_digest(entries, INDEX)
    write_table(due.unionByName(due_parts(data, part_rows)) if csv else due, os.path.join(home, DIGESTS))
    return _verify(spark, root, version, strict=strict)


def audit(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """``(kind, part_file, lines, bytes, damaged)`` for every CSV part, the index and the JSON index of a version,
    the live one by default.

    What the files hold now is compared with digests that were taken from the rows when the version was made:
    each line of a part at its place, each entry of an index.  Damage of equal length is told, and lost or
    added parts.  Blanks between the entries of the JSON index are not looked at, and the data table is
    not read.  Versions made before digests were kept are an error.
    """
    home = os.path.join(root, VERSIONS, version or load_manifest(spark, root)["version"])
    if not exists(spark, os.path.join(home, DIGESTS, "_SUCCESS")):
        raise ValueError(f"no digests in {home}")
    due = spark.read.parquet(os.path.join(home, DIGESTS))
    of_index, of_parts = due.filter(F.col("part_file") == INDEX), due.filter(F.col("part_file") != INDEX)
    checks = [compare(of_index, entries_digest(read_index(spark, os.path.join(home, INDEX)), INDEX)).withColumn("kind", F.lit(INDEX))]
    if exists(spark, os.path.join(home, INDEX_JSON, "_SUCCESS")):
        entries = entries_digest(read_index_json(spark, os.path.join(home, INDEX_JSON)), INDEX_JSON)
        checks.append(compare(of_index.withColumn("part_file", F.lit(INDEX_JSON)), entries).withColumn("kind", F.lit(INDEX_JSON)))
    parts = os.path.join(home, CSV)
    if exists(spark, os.path.join(parts, "_SUCCESS")):
        # A folder without parts has no column of their names.
        none = not any(name.startswith("part_file=") for name in children(spark, parts))
        found = of_parts.limit(0) if none else found_parts(read_part_lines(spark, parts))
        checks.append(compare(of_parts, found).withColumn("kind", F.lit(CSV)))
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result.select("kind", "part_file", "lines", "bytes", "damaged")


def _verify(spark: SparkSession, root: str, version: str, *, strict: bool) -> Version:
    """Check what a version holds against each other, and name only what it holds.

    Data and index are always there.  CSV parts and the JSON index are checked if they were written, by
    sizes and then by ``audit``; without CSV parts the data table is the version's file.
    """
    home = os.path.join(root, VERSIONS, version)
    for needed in (DATA, INDEX):
        if not exists(spark, os.path.join(home, needed, "_SUCCESS")):
            raise RuntimeError(f"{version} has no complete {needed}")
    csv = exists(spark, os.path.join(home, CSV, "_SUCCESS"))
    index_json = exists(spark, os.path.join(home, INDEX_JSON, "_SUCCESS"))
    data = read_data(spark, os.path.join(home, DATA))
    rows, size = data.agg(F.count(F.lit(1)), F.coalesce(F.sum("byte_length"), F.lit(0))).first()
    end = F.coalesce(F.max(F.col("byte_offset") + F.col("byte_length")), F.lit(HEADER_BYTES))
    entries, index_end = read_index(spark, os.path.join(home, INDEX)).agg(F.count(F.lit(1)), end).first()
    if index_end != size + HEADER_BYTES:
        raise RuntimeError(f"index of {version} ends at byte {index_end}, its data at {size + HEADER_BYTES}")
    if csv and rows:
        written = listed_bytes(spark, os.path.join(home, CSV), "*.txt")
        if written != size:
            raise RuntimeError(f"CSV parts of {version} hold {written} bytes, expected {size}")
    if entries != rows:
        message = (f"index size mismatch in {version}: {entries} entries, {rows} rows, "
                   f"difference {rows - entries}")
        if strict:
            raise RuntimeError(message)
        warnings.warn(message, stacklevel=2)
    json_bytes = listed_bytes(spark, os.path.join(home, INDEX_JSON), "*.txt") if index_json and rows else None
    if json_bytes is not None:
        due = json_index_bytes(read_index(spark, os.path.join(home, INDEX))).first()[0]
        if json_bytes != due:
            raise RuntimeError(f"JSON index of {version} holds {json_bytes} bytes, expected {due}")
    if exists(spark, os.path.join(home, DIGESTS, "_SUCCESS")):
        damaged = audit(spark, root, version).filter("damaged").select("part_file").orderBy("part_file").limit(SHOWN).collect()
        if damaged:
            raise RuntimeError(f"{version} is damaged in {', '.join(r.part_file for r in damaged)}")
    return Version(version, f"{VERSIONS}/{version}/{CSV if csv else DATA}", f"{VERSIONS}/{version}/{INDEX}", rows, entries,
                   size, listed_bytes(spark, os.path.join(home, INDEX), "*.parquet"), json_bytes)


def full_build(spark: SparkSession, root: str, source: DataFrame | None = None, *,
               target_gb: float = DEFAULT_GB, seed: int = 0, now: datetime | None = None,
               num_parts: int | None = None, part_rows: int = PART_ROWS, csv: bool = True,
               index_json: bool = False, strict: bool = False, service_name: str = "dictionary",
               service_description: str = "", service_author: str = "") -> Version:
    """Publish ``source`` (``title, value, ord``) as a first version; synthetic rows by default."""
    stamp, iso = stamps(spark, now)
    seen = load_manifest(spark, root)
    if source is None:
        source = generate(spark, target_gb=target_gb, seed=seed, sort=False)
    ordered = stable_sort(source, num_parts).select("title", "value", "k")
    version = claim_version(spark, root, stamp)
    made = _publish(spark, root, version, ordered, part_rows=part_rows, csv=csv, index_json=index_json,
                    strict=strict)
    switch_manifest(spark, os.path.join(root, MANIFEST_FILE), {
        "service_name": service_name, "service_description": service_description,
        "service_author": service_author, "file_path": made.file_path,
        "index_file_path": made.index_file_path, "changelog_file_path": "",
        "last_updated_at": iso, "version": made.version,
    }, seen)
    return made


def generate_csv(spark: SparkSession, path: str, *, num_rows: int | None = None,
                 target_gb: float | None = None, seed: int = 0, sort: bool = True,
                 templates: list[str] = FULL_TEMPLATES, part_rows: int = PART_ROWS) -> dict[str, int]:
    """Write a synthetic dictionary as a header and CSV parts below ``path``; report its size.

    Unsorted rows keep the order they were drawn in.
    """
    rows = generate(spark, num_rows=num_rows, target_gb=target_gb, seed=seed, sort=False, templates=templates)
    ordered = stable_sort(rows) if sort else range_sort(rows, ["ord"])
    data = data_table(ordered.select(*DICT.names), lambda df: materialise(df, "generated"))
    write_csv_header(spark, os.path.join(path, "header.csv"))
    write_csv_parts(data, os.path.join(path, CSV), part_rows)
    return {"rows": data.count(), "bytes": listed_bytes(spark, os.path.join(path, CSV), "*.txt") + HEADER_BYTES}


def current_rows(spark: SparkSession, root: str, file_path: str) -> DataFrame:
    """Rows of a version as merge input: its data table, or a plain CSV made elsewhere."""
    path = os.path.join(root, file_path)
    data = os.path.join(os.path.dirname(path), DATA)
    if exists(spark, data):
        return as_dictionary(read_data(spark, data))
    return read_dictionary(spark, path)


def incremental_build(spark: SparkSession, root: str, changelog: DataFrame | None = None, *,
                      changelog_path: str | None = None, now: datetime | None = None,
                      num_parts: int | None = None, part_rows: int = PART_ROWS, csv: bool = True,
                      index_json: bool = False, strict: bool = False, tag: str = "") -> Version:
    """Upsert a changelog into the live version and publish the result.

    The changelog is given as rows, as a path, or by the manifest; it is evaluated once.  The manifest
    keeps every field but the version's own, and is only switched after the new version was verified.
    ``tag`` goes into the version's name after its date.
    """
    manifest = load_manifest(spark, root)
    if changelog is None:
        changelog_path = changelog_path or manifest.get("changelog_file_path")
        if not changelog_path:
            raise ValueError("missing or empty required manifest field: changelog_file_path")
    if not manifest.get("file_path"):
        raise ValueError("missing or empty required manifest field: file_path")
    if changelog is None:
        changelog = read_dictionary(spark, os.path.join(root, changelog_path))
    changelog = materialise(changelog.select(*DICT.names, "ord"), "changelog")
    existing = current_rows(spark, root, manifest["file_path"])

    stamp, iso = stamps(spark, now)
    version = claim_version(spark, root, f"{stamp}-{tag}" if tag else stamp)
    merged = upsert(existing, changelog, ordered=True, num_parts=num_parts)
    made = _publish(spark, root, version, merged.select("title", "value", "k"),
                    part_rows=part_rows, csv=csv, index_json=index_json, strict=strict)
    made.counters = _counters(existing.count(), changelog.count(), made.rows)
    seen = dict(manifest)
    manifest |= {"file_path": made.file_path, "index_file_path": made.index_file_path,
                 "last_updated_at": iso, "version": made.version}
    switch_manifest(spark, os.path.join(root, MANIFEST_FILE), manifest, seen)
    return made


def _counters(existing: int, changelog: int, total: int) -> dict[str, int]:
    """Merge counters from what was read and written: total = existing + added."""
    added = total - existing
    return {"existing_count": existing, "changelog_count": changelog,
            "updated_count": changelog - added, "added_count": added, "total_count": total}


def build(spark: SparkSession, root: str, *, source: DataFrame | None = None, **options) -> Version:
    """Incremental if the manifest names a data file, else full.

    A first run finds neither a manifest nor versions.  Versions without a manifest mean that it was
    lost, and a full build would take the place of their data.
    """
    manifest = load_manifest(spark, root)
    if manifest.get("file_path", "").strip():
        return incremental_build(spark, root, **options)
    if not manifest and children(spark, os.path.join(root, VERSIONS)):
        raise RuntimeError(f"{root} has versions but no manifest: roll back to one of them")
    return full_build(spark, root, source, **options)


def rollback(spark: SparkSession, root: str, version: str, now: datetime | None = None) -> None:
    """Point the manifest back at an earlier version, after checking its files once more."""
    if not exists(spark, os.path.join(root, VERSIONS, version, DATA, "_SUCCESS")):
        raise ValueError(f"no such version: {version}")
    made = _verify(spark, root, version, strict=False)
    manifest = load_manifest(spark, root)
    manifest |= {"file_path": made.file_path, "index_file_path": made.index_file_path,
                 "last_updated_at": stamps(spark, now)[1], "version": version}
    write_manifest(spark, os.path.join(root, MANIFEST_FILE), manifest)


def live_data(spark: SparkSession, root: str) -> DataFrame:
    """The live version's data table, named by the manifest."""
    home = os.path.dirname(os.path.join(root, load_manifest(spark, root)["file_path"]))
    return read_data(spark, os.path.join(home, DATA))


def live_index(spark: SparkSession, root: str) -> DataFrame:
    return read_index(spark, os.path.join(root, load_manifest(spark, root)["index_file_path"]))


def live_csv(spark: SparkSession, root: str) -> str:
    """Path of the live version's CSV parts."""
    path = load_manifest(spark, root)["file_path"]
    if not path.endswith(CSV):
        raise ValueError(f"the live version has no CSV parts: {path}")
    return os.path.join(root, path)


def live_index_json(spark: SparkSession, root: str) -> DataFrame:
    """The live version's JSON index."""
    home = os.path.dirname(os.path.join(root, load_manifest(spark, root)["index_file_path"]))
    return read_index_json(spark, os.path.join(home, INDEX_JSON))
