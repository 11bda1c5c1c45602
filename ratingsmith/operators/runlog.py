"""Run log, table statistics and change detection.

The log is an append-only table, one file an entry; reports over it are small aggregates.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructType

from ratingsmith.functions import half_up
from ratingsmith.sources import files
from ratingsmith.sources.contracts import AUDIT_SCHEMAS

RUN_LOG_SCHEMA = AUDIT_SCHEMAS["pipeline_run_log"]
TABLE_STATS_SCHEMA = AUDIT_SCHEMAS["pipeline_table_stats"]


def _latest(log: DataFrame, date: str = "run_date", run_id: str = "run_id") -> DataFrame:
    """The newest row (ties by run id), as a one-row DataFrame."""
    return log.orderBy(F.col(date).desc(), F.col(run_id).desc()).limit(1)


def last_run(log: DataFrame) -> DataFrame:
    """L3: the latest run of any status."""
    return _latest(log)


def last_success(log: DataFrame) -> DataFrame:
    return _latest(log.filter(F.col("status") == "success"))


def run_history(log: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` runs with the duration in minutes (1 place)."""
    return _latest_n(log, n).select(
        "run_id", "run_date", "status", "rows_loaded",
        half_up(F.col("duration_secs") / F.lit(60.0), 1).alias("duration_mins"))


def _latest_n(log: DataFrame, n: int) -> DataFrame:
    return log.orderBy(F.col("run_date").desc(), F.col("run_id").desc()).limit(n)


def last_success_stats(log: DataFrame, stats: DataFrame) -> DataFrame:
    """Per-table row counts of the latest successful run."""
    last = last_success(log).select("run_id")
    return stats.join(last, "run_id").select("table_name", "row_count").orderBy(
        F.col("row_count").desc(), "table_name")


def run_kpis(log: DataFrame) -> DataFrame:
    """Last success time, total runs, success rate (%), latest run's duration and status."""
    ok = F.col("status") == "success"
    order = F.struct(F.col("run_date"), F.col("run_id"))
    return log.agg(
        F.max(F.when(ok, F.col("run_date"))).alias("last_success_date"),
        F.count(F.lit(1)).alias("total_runs"),
        half_up(F.lit(100.0) * F.count_if(ok) / F.count(F.lit(1)), 2).alias("success_rate"),
        F.max_by("duration_secs", order).alias("last_duration_secs"),
        F.max_by("status", order).alias("last_status"))


def status_counts(log: DataFrame) -> DataFrame:
    """Runs per status."""
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("runs"))


# ---- fingerprints and change detection ----------------------------------------

def row_digest(df: DataFrame) -> Column:
    """The first 60 bits of MD5 over a row's values, as a number.

    Every value is preceded by a mark that tells NULL from a value and by its length,
    so neither moving a value past a NULL nor shifting text between columns goes unseen.
    """
    parts = []
    for c in df.columns:
        v = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.lit("+"), F.length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast(DecimalType(38, 0))


def native_digest(df: DataFrame) -> Column:
    """Two 64-bit hashes of a row as one number, without forming text; NULL marks are hashed with the values.

    For comparisons within one code version only: SQL cannot follow it, and it is no defence against
    rows made to collide.
    """
    marked = [x for c in df.columns for x in (F.col(c).isNull(), F.col(c))]
    high, low = (F.xxhash64(F.lit(seed), *marked).cast(DecimalType(38, 0)) for seed in (11, 23))
    return (high.cast("decimal(19,0)") * F.lit(2 ** 40).cast("decimal(13,0)")).cast(DecimalType(38, 0)) + low


def fingerprint(df: DataFrame, table: str, digest: Callable[[DataFrame], Column] = row_digest) -> DataFrame:
    """Order-insensitive table fingerprint: row count and sum of row digests.

    A sum (not XOR) so a duplicated row changes the value; DECIMAL(38,0) so
    the sum never overflows.  Stable under repartitioning and row order.
    """
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.coalesce(F.sum(digest(df)), F.lit(0)).alias("fingerprint")).select(
        F.lit(table).alias("table_name"), "row_count",
        F.col("fingerprint").cast("string").alias("fingerprint"))


def fingerprints(tables: Mapping[str, DataFrame], digest: Callable[[DataFrame], Column] = row_digest) -> DataFrame:
    frames = [fingerprint(df, name, digest) for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def metadata_matches(saved: DataFrame, current: DataFrame, key: str = "source",
                     fields: Sequence[str] = ("etag", "last_modified", "content_length")) -> DataFrame:
    """Per source, does the saved metadata match the current one?

    The first field present on both sides decides (priority in ``fields``); an empty
    string counts as absent.  With nothing comparable the answer is False, so the
    input is reloaded.
    """
    given = lambda f: F.nullif(F.col(f).cast("string"), F.lit(""))
    s = saved.select(key, *[given(f).alias(f"s_{f}") for f in fields])
    c = current.select(key, *[given(f).alias(f"c_{f}") for f in fields])
    j = s.join(c, key, "full_outer")
    decide = None
    for f in fields:
        both = F.col(f"s_{f}").isNotNull() & F.col(f"c_{f}").isNotNull()
        cmp = F.col(f"s_{f}") == F.col(f"c_{f}")
        decide = F.when(both, cmp) if decide is None else decide.when(both, cmp)
    return j.select(key, decide.otherwise(F.lit(False)).alias("matches"))


def listing_metadata(spark: SparkSession, path: str, source: str) -> DataFrame:
    """C1 inputs for the files below ``path``: one row (source, etag, last_modified, content_length).

    Taken from the file listing (the ``binaryFile`` source without its content), so no
    byte of the data is read.  ``etag`` is an order-independent sum over (path, size,
    time), so any added, removed or rewritten file changes it.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", F.col("modificationTime").alias("at")))
    return files.agg(F.coalesce(F.sum(row_digest(files)), F.lit(0)).cast("string").alias("etag"),
                     F.max("at").cast("string").alias("last_modified"),
                     F.sum("length").cast("string").alias("content_length")).select(
        F.lit(source).alias("source"), "etag", "last_modified", "content_length")


def all_match(saved: DataFrame | None, current: DataFrame) -> bool:
    """True when every current source has saved metadata that matches."""
    if saved is None:
        return False
    m = metadata_matches(saved, current).join(current.select("source"), "source")
    row = m.agg(F.count(F.lit(1)).alias("n"), F.count_if("matches").alias("ok")).first()
    return row["n"] > 0 and row["n"] == row["ok"]


def changed_tables(current: DataFrame, saved: DataFrame | None) -> DataFrame:
    """table_name, changed — compared with the last saved fingerprints.

    With no saved state every table counts as changed (the safe default).
    """
    if saved is None:
        return current.select("table_name", F.lit(True).alias("changed"))
    cur = current.select(F.col("table_name").alias("source"), F.col("fingerprint").alias("etag"),
                         F.lit(None).cast("string").alias("last_modified"),
                         F.col("row_count").alias("content_length"))
    old = saved.select(F.col("table_name").alias("source"), F.col("fingerprint").alias("etag"),
                       F.lit(None).cast("string").alias("last_modified"),
                       F.col("row_count").alias("content_length"))
    m = metadata_matches(old, cur)
    return cur.select("source").join(m, "source", "left").select(
        F.col("source").alias("table_name"), (~F.coalesce("matches", F.lit(False))).alias("changed"))


# ---- appends (L1, L2, L6) ----------------------------------------------------------

def _entry(path: str, number: int) -> str:
    return os.path.join(path, f"{number:012d}.json")


def read_log(spark: SparkSession, path: str, schema: StructType = RUN_LOG_SCHEMA) -> DataFrame:
    """The log table, or an empty one before the first append.  An entry is one file of JSON lines."""
    if not files.names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(path)


def append_run(spark: SparkSession, path: str, dataset_hash: str | None, status: str,
               rows_loaded: int | None, duration_secs: int | None,
               source_url: str | None = None, pipeline_version: str = "unknown") -> int:
    """Append one run row; the run id is the next free number.

    The entry's file is named by the id and only written if it is not there, so of several
    appends at once each gets its own id and none is lost.
    """
    have = files.names(spark, path)
    run_id = int(have[-1].split(".")[0]) + 1 if have else 1
    while True:
        at = dt.datetime.now(dt.timezone.utc).isoformat()
        row = dict(zip(RUN_LOG_SCHEMA.fieldNames(), (run_id, at, dataset_hash, status, rows_loaded, duration_secs, source_url,
                                                     pipeline_version), strict=True))
        if files.put_if_absent(spark, _entry(path, run_id), json.dumps(row)):
            return run_id
        run_id += 1


def append_table_stats(counts: DataFrame, run_id: int, path: str) -> None:
    """L2: per-table row counts of one run (one row a table), as the entry of that run."""
    rows = [json.dumps({"run_id": run_id, "table_name": r["table_name"], "row_count": int(r["row_count"])})
            for r in counts.select("table_name", "row_count").collect()]
    if not files.put_if_absent(counts.sparkSession, _entry(path, run_id), "\n".join(rows)):
        raise FileExistsError(f"{path}: run {run_id} has its statistics already")
