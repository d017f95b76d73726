"""Loading the query log into the ``traces`` and ``feedback`` tables.

Both are kept in buckets of the query id. A load writes a new version that holds the
buckets it touched and a manifest that names, for every bucket, the version its file is in.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.upsert import latest_per_key
from lodestone.session import EXPANSION
from lodestone.sources.eventlog import EVENT, feedback_of, flatten_usage, read_log, traces_of
from lodestone.sources.versions import (
    MARKER, complete_versions, drop, file_sizes, latest_version, mark_complete, next_version, older_versions,
    path_exists, read_text, write_text,
)

KINDS = {"trace": "traces", "feedback": "feedback"}
MANIFEST = "_MANIFEST"
FILE_FIELDS = ("path", "modificationTime", "length")
PLACE = ("table_name", "bucket")
# The fewest buckets of a table, and the bytes one may have before all are halved.
BUCKETS = 16
BUCKET_BYTES = 512 * 1024 * 1024


def _empty(spark: SparkSession) -> dict[str, DataFrame]:
    nothing = spark.createDataFrame([], EVENT)
    return {"traces": traces_of(nothing).drop("event_type"), "feedback": feedback_of(nothing).drop("event_type")}


def _manifest(spark: SparkSession, version: str) -> dict:
    return json.loads(read_text(spark, f"{version}/{MANIFEST}"))


def bucket_paths(spark: SparkSession, root: str, name: str) -> dict[int, str]:
    """Where each bucket of the table lies as last loaded."""
    version = latest_version(spark, root)
    places = {} if version is None else _manifest(spark, version)["places"].get(name, {})
    return {int(b): f"{root}/{place}/rows/table_name={name}/bucket={b}" for b, (place, _) in places.items()}


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    if latest_version(spark, root) is None:
        return None
    empty, paths = _empty(spark)[name], bucket_paths(spark, root, name)
    return spark.read.schema(empty.schema).parquet(*paths.values()) if paths else empty


def load_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Both tables as last loaded; empty ones, with their columns, before the first load."""
    stored = {name: open_table(spark, root, name) for name in KINDS.values()}
    return {name: _empty(spark)[name] if table is None else table for name, table in stored.items()}


def refresh_views(spark: SparkSession, log_dir: str, root: str) -> None:
    """Load the log and point the views ``traces`` and ``feedback`` at the result."""
    for name, table in run_telemetry(spark, log_dir, root).items():
        table.createOrReplaceTempView(name)


def log_files(spark: SparkSession, log_dir: str) -> DataFrame:
    """The files of the log as they are now; their content is not read."""
    return spark.read.format("binaryFile").load(log_dir).select(*FILE_FIELDS)


def run_telemetry(spark: SparkSession, log_dir: str, root: str) -> dict[str, DataFrame]:
    """Merge what the log has into both tables. Running it again changes nothing.

    Files that an earlier load has read are passed over, since of their rows and the new
    ones the latest by time is what the whole log would give. That holds while files are only
    added; once one was changed or taken away, rows of the log win over stored ones as a
    whole, so from then on every load that finds a difference reads all of it.

    The lines are parsed once: reduced to a row a key, they are written by bucket, and the
    folders of that writing tell which stored buckets must be read and written again. A failed
    run leaves the tables as they were, and files being read are never overwritten.
    """
    if not path_exists(spark, log_dir):
        return load_tables(spark, root)
    before = latest_version(spark, root)
    listed = log_files(spark, log_dir)
    whole, held = False, None
    if before is not None:
        held, known = _manifest(spark, before), spark.read.parquet(f"{before}/files")
        gone = not known.join(listed, list(FILE_FIELDS), "left_anti").isEmpty()
        if not gone and listed.join(known, list(FILE_FIELDS), "left_anti").isEmpty():
            return load_tables(spark, root)
        whole = gone or held["whole"]
    folder = next_version(spark, root)
    listed.write.parquet(f"{folder}/files")
    if held is None or whole:
        events = read_log(spark, log_dir)
        size = spark.read.parquet(f"{folder}/files").agg(F.sum("length")).first()[0] or 0
    else:
        new = spark.read.parquet(f"{folder}/files").join(known, list(FILE_FIELDS), "left_anti").collect()
        events, size = read_log(spark, [r["path"] for r in new]), sum(r["length"] for r in new)
    _load(spark, root, folder, held, events, size, whole)
    mark_complete(spark, folder)
    return load_tables(spark, root)


def _by_bucket(rows: DataFrame, path: str) -> dict[tuple[str, int], int]:
    """Write rows by table and bucket; returns the bytes of each bucket that has any."""
    rows.repartition(*PLACE).write.mode("overwrite").partitionBy(*PLACE).parquet(path)
    sizes: dict[tuple[str, int], int] = {}
    for name, length in file_sizes(rows.sparkSession, path).items():
        parts = name.split("/")
        if len(parts) == 3 and not parts[2].startswith((".", "_")):
            place = parts[0].split("=")[1], int(parts[1].split("=")[1])
            sizes[place] = sizes.get(place, 0) + length
    return sizes


def _load(
    spark: SparkSession, root: str, folder: str, held: dict | None, events: DataFrame, size: int, batch_wins: bool
) -> None:
    stored = held["places"] if held else {name: {} for name in KINDS.values()}
    total = size // EXPANSION + sum(length for places in stored.values() for _, length in places.values())
    buckets = held["buckets"] if held else BUCKETS
    while total > buckets * BUCKET_BYTES:
        buckets *= 2
    split = held is not None and buckets != held["buckets"]

    bucket = F.pmod(F.xxhash64("query_id"), F.lit(buckets)).cast("int").alias("bucket")
    kind = F.create_map(*(F.lit(v) for pair in KINDS.items() for v in pair))[F.col("event_type")]
    flat = flatten_usage(events.where(F.col("event_type").isin(*KINDS)))
    batch = latest_per_key(
        flat.select(kind.alias("table_name"), bucket, *(c for c in flat.columns if c != "event_type")),
        (*PLACE, "query_id"), "timestamp")

    place = folder.rsplit("/", 1)[1]
    if not any(stored.values()):
        written = _by_bucket(batch, f"{folder}/rows")
    else:
        staged = f"{folder}/batch"
        touched = set(_by_bucket(batch, staged))
        sides = spark.read.schema(batch.schema).parquet(staged).withColumn("_side", F.lit(1 if batch_wins else 0))
        for name, places in stored.items():
            old = [f"{root}/{at}/rows/table_name={name}/bucket={b}" for b, (at, _) in places.items()
                   if split or (name, int(b)) in touched]
            if old:
                rows = spark.read.schema(batch.drop(*PLACE).schema).parquet(*old)
                sides = sides.unionByName(rows.select(F.lit(name).alias("table_name"), bucket, "*", F.lit(0).alias("_side")))
        written = _by_bucket(latest_per_key(sides, (*PLACE, "query_id"), "_side", "timestamp").drop("_side"), f"{folder}/rows")
        drop(spark, staged)
    places = {name: {} if split else dict(kept) for name, kept in stored.items()}
    for (name, number), length in written.items():
        places[name][str(number)] = (place, length)
    write_text(spark, f"{folder}/{MANIFEST}", json.dumps({"buckets": buckets, "whole": batch_wins, "places": places}))


def drop_old_loads(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Close all but the newest ``keep`` complete versions and delete the buckets that none of those names,
    and older versions that hold nothing else. Returns what was deleted."""
    kept = complete_versions(spark, root)[-keep:]
    named = {
        f"{at}/rows/table_name={name}/bucket={b}" for version in kept
        for name, places in _manifest(spark, version)["places"].items() for b, (at, _) in places.items()
    }
    dropped = []
    for version in older_versions(spark, root, kept[0]) if kept else []:
        at = version.rsplit("/", 1)[1]
        drop(spark, f"{version}/{MARKER}")
        held = {f"{at}/{f.rsplit('/', 1)[0]}" for f in file_sizes(spark, version) if f.startswith("rows/table_name=")}
        unused = sorted(f"{root}/{b}" for b in held - named) if held & named else [version]
        for folder in unused:
            drop(spark, folder)
        dropped += unused
    return dropped
