"""One batch refresh: change check, clean, analytics, star write, quality, audit.

Stages hand over through written tables, which also cuts lineage: a lost
executor recomputes only from the last written stage, never from the raw
input.  Every run writes folders of its own and commits them all at once
(``plans.versions``).  Only bounded values reach the driver: five fingerprint rows, the years
of the data, what the writes observed and the quality summary counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingsmith import __version__
from ratingsmith.operators import aggregates as agg
from ratingsmith.operators import clean
from ratingsmith.operators import quality as qc
from ratingsmith.operators import runlog as rl
from ratingsmith.operators import windows as win
from ratingsmith.plans import versions as vs
from ratingsmith.plans import warehouse as wh
from ratingsmith.sources import csv as csv_src
from ratingsmith.sources import files
from ratingsmith.sources.adapters import Inputs
from ratingsmith.sources.contracts import (
    AUDIT_KEYS, AUDIT_MAX_LENGTHS, AUDIT_NOT_NULL, INPUTS, WAREHOUSE_KEYS, WAREHOUSE_MAX_LENGTHS, WAREHOUSE_NOT_NULL,
    WAREHOUSE_TABLES, table_schema,
)


STATE = {"fingerprints": "table_name string, row_count long, fingerprint string",
         "metadata": "source string, etag string, last_modified string, content_length string",
         "settings": "source string, version string, params string"}


def saved_state(spark: SparkSession, out_dir: str, name: str) -> DataFrame | None:
    """State of the newest version (fingerprints, metadata, settings), kept in its manifest."""
    now = vs.latest(spark, out_dir)
    rows = now.info.get(name) if now else None
    return None if rows is None else spark.createDataFrame([tuple(r) for r in rows], STATE[name])


def settings(spark: SparkSession, source: str, params: wh.StarParams) -> DataFrame:
    """What the outputs depend on besides the input's content: one row."""
    row = (source, __version__, json.dumps(asdict(params), sort_keys=True))
    return spark.createDataFrame([row], "source string, version string, params string")


def outputs_stand(spark: SparkSession, out_dir: str, now: DataFrame) -> bool:
    """Whether the newest version had the same settings and all its tables are still there."""
    last = vs.latest(spark, out_dir)
    if last is None or [tuple(r) for r in last.info["settings"]] != [tuple(r) for r in now.collect()]:
        return False
    return vs.stands(spark, out_dir, last, WAREHOUSE_TABLES)


def quality_suite(tables, raw_rows: int, previous_stats: DataFrame | None, metrics: Mapping[str, Mapping],
                  drift_warn_pct: float = 0.20, row_floor: float = 0.90, inputs: Inputs | None = None,
                  audit: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """All post-load checks as one DataFrame, plus the drift table.

    ``metrics`` has what the writes observed of each table, so that only keys are looked for in a
    scan, one a table.  ``inputs`` and ``audit`` add the contracts of the raw inputs (warnings)
    and of the audit tables.
    """
    fact = tables["fact_ratings"]
    spark = fact.sparkSession
    rows = []
    for t in WAREHOUSE_TABLES:
        rows += qc.observed_checks(t, metrics[t], wh.BOUNDED.get(t))
    loaded, floor = metrics["fact_ratings"]["row_count"], int(row_floor * raw_rows)
    rows.append(("row_floor", "fact_ratings", float(loaded), float(floor), loaded >= floor, qc.WARNING))
    checks = [spark.createDataFrame(rows, qc.SCHEMA),
              qc.key_checks(fact, WAREHOUSE_KEYS["fact_ratings"],
                            {"movie_id": tables["dim_movies"], "user_id": tables["dim_users"]}, "fact_ratings")]
    checks += [qc.duplicate_keys(tables[t], k, t, hashed=t in wh.PAIR_TABLES) for t, k in WAREHOUSE_KEYS.items() if t != "fact_ratings"]
    checks += [qc.input_contract(df, INPUTS[name]) for name, df in (inputs.as_dict() if inputs else {}).items()]
    for t, df in (audit or {}).items():
        checks += [qc.contract_violations(df, t, AUDIT_NOT_NULL[t], AUDIT_MAX_LENGTHS[t]), qc.duplicate_keys(df, AUDIT_KEYS[t], t)]
    counts = spark.createDataFrame([(t, int(metrics[t]["row_count"])) for t in WAREHOUSE_TABLES], "table_name string, row_count bigint")
    prev = previous_stats if previous_stats is not None else spark.createDataFrame([], counts.schema)
    return qc.union_all(checks), qc.drift(counts, prev, drift_warn_pct)


@dataclass
class RefreshResult:
    run_id: int
    status: str
    changed: list[str] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)
    failed_checks: int = 0
    version: int | None = None
    rebuilt_years: list[int] | None = None


def refresh(spark: SparkSession, inputs: Inputs | Callable[[], Inputs], out_dir: str, source: str,
            params: wh.StarParams = wh.StarParams(), force: bool = False,
            source_url: str | None = None, metadata: DataFrame | None = None, incremental: bool = False) -> RefreshResult:
    """Run the whole batch; skip (and log the skip) when nothing would change.

    A run is skipped only if the newest version used the same source, parameters and
    code version, all its tables are there, and the input is unchanged.  ``metadata`` (one row
    per input: source, etag, last_modified, content_length, e.g.
    ``sources.csv.input_metadata``) enables the cheap check: when it matches the one
    saved by the newest version, no data is read (pass ``inputs`` as a function, so
    that not even CSV files are staged).  Otherwise content fingerprints decide.

    Tables are written into folders of this run, and become the newest version (``plans.versions``)
    only when all are written and no check failed: readers that use ``versions.read_table`` see
    this run's tables or those of an earlier one, never a mix.  ``paths`` are the folders that this run wrote; they
    stand until the next but one version.

    ``incremental=True`` rebuilds what changed only.  Digests of the clean ratings by (year, hash bucket) are
    compared with those of the newest version.  Years before the first changed one keep their fact folders; later ones
    go on from the state at its start (totals by item and year, daily totals of the last ``rolling_days``
    days).  Trends and item statistics come from totals by year, of which only changed years are
    worked out again.  Read such tables with ``versions.read_table``; ``paths`` has their roots.

    All state lies in ``out_dir``.  Every execution leaves a row in the run log;
    one that raises leaves ``failed`` and raises on, and one that is killed stays listed by ``versions.running``.
    """
    started = time.time()
    run = _Run(spark, out_dir, source, params, source_url, started, incremental)
    mark = vs.mark(spark, out_dir, run.token)
    try:
        return run.execute(inputs, force, metadata)
    except BaseException:
        run.log("failed", None, 0)
        raise
    finally:
        files.delete(spark, mark)


def refresh_csv(spark: SparkSession, raw_dir: str, out_dir: str, params: wh.StarParams = wh.StarParams(),
                force: bool = False, incremental: bool = False) -> RefreshResult:
    """``refresh`` of a folder of CSV files: malformed lines apart, unchanged files not read."""
    staged = os.path.join(out_dir, "_staging", "inputs", uuid.uuid4().hex)
    try:
        return refresh(spark, lambda: csv_src.read_inputs(spark, raw_dir, staged), out_dir, raw_dir, params, force,
                       source_url=raw_dir, metadata=csv_src.input_metadata(spark, raw_dir), incremental=incremental)
    finally:
        files.delete(spark, staged)


#: Hash buckets of items that the digests of a year are kept by.
DIGEST_BUCKETS = 64


def year_digests(ratings: DataFrame, item: str = "movieId", by: str = "rating_year") -> DataFrame:
    """``by, bucket, rows, a, b``: order-insensitive digests of the rows, two 64-bit hashes summed up."""
    cells = ratings.select(F.col(by), F.pmod(F.xxhash64(item), F.lit(DIGEST_BUCKETS)).alias("bucket"),
                           *(F.xxhash64(F.lit(seed), *ratings.columns).cast("decimal(38,0)").alias(c) for c, seed in (("a", 1), ("b", 2))))
    return cells.groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("a").cast("decimal(38,0)").alias("a"),
                                           F.sum("b").cast("decimal(38,0)").alias("b"))


def changed_years(now: DataFrame, before: DataFrame, by: str = "rating_year") -> DataFrame:
    """The years in which any cell of the digests differs, is new or is gone."""
    same = [by, "bucket", "rows", "a", "b"]
    once = now.select(*same).unionAll(before.select(*same)).groupBy(*same).agg(F.count(F.lit(1)).alias("n")).filter("n = 1")
    return once.select(by).distinct()


@dataclass
class _Run:
    spark: SparkSession
    out_dir: str
    source: str
    params: wh.StarParams
    source_url: str | None
    started: float
    incremental: bool = False
    token: str = field(default_factory=lambda: f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}")

    def path(self, *parts: str) -> str:
        return os.path.join(self.out_dir, *parts)

    @property
    def log_path(self) -> str:
        return self.path("_audit", "pipeline_run_log")

    def log(self, status: str, dataset_hash: str | None, rows: int) -> int:
        return rl.append_run(self.spark, self.log_path, dataset_hash, status, rows,
                             int(time.time() - self.started), self.source_url, __version__)

    def execute(self, inputs, force: bool, metadata: DataFrame | None) -> RefreshResult:
        spark = self.spark
        now = settings(spark, self.source, self.params)
        last = vs.latest(spark, self.out_dir)
        stand = not force and outputs_stand(spark, self.out_dir, now)
        if metadata is not None:
            metadata = metadata.checkpoint(eager=True)
            if stand and rl.all_match(saved_state(spark, self.out_dir, "metadata"), metadata):
                return RefreshResult(self.log("skipped", None, 0), "skipped")
        if callable(inputs):
            inputs = inputs()

        # Fingerprints of the inputs (five rows) against the last saved ones.
        current = rl.fingerprints(inputs.as_dict(), rl.native_digest).checkpoint(eager=True)
        fp_rows = sorted(tuple(r) for r in current.collect())
        dataset_hash = hashlib.sha256(repr(fp_rows).encode()).hexdigest()
        changed = [r["table_name"] for r in
                   rl.changed_tables(current, saved_state(spark, self.out_dir, "fingerprints")).filter("changed").collect()]
        info = {"settings": [tuple(r) for r in now.collect()], "fingerprints": fp_rows}
        if metadata is not None:
            info["metadata"] = [tuple(r) for r in metadata.collect()]
        if stand and not changed:
            if metadata is not None:          # same content under new file metadata
                self.commit(vs.Manifest(last.run, last.tables, last.info | info), onto=last.version)
            return RefreshResult(self.log("skipped", dataset_hash, 0), "skipped")

        # What a partial run may take over: the same settings, standing tables, the same items.
        usable = self.incremental and stand and last is not None and "digests" in last.tables and "movies" not in changed
        base = last if usable and vs.stands(spark, self.out_dir, last, last.tables) else None
        manifest, failed, counts, years = self.build(inputs, base, changed, {r[0]: r[1] for r in fp_rows}["ratings"])
        manifest.info = info
        status = "success" if failed == 0 else "failed"
        if failed == 0:
            self.commit(manifest, onto=base.version if base else None)
        run_id = self.log(status, dataset_hash, {r[0]: r[1] for r in counts}["fact_ratings"])
        rl.append_table_stats(spark.createDataFrame(counts, "table_name string, row_count long"), run_id,
                              self.path("_audit", "pipeline_table_stats"))
        mine = [f"v={self.token}"]
        whole = {t for t in WAREHOUSE_TABLES if all(f.startswith(mine[0]) for f in manifest.tables[t].folders)}
        paths = {t: self.path("warehouse", t, *(mine if t in whole else [])) for t in WAREHOUSE_TABLES}
        return RefreshResult(run_id, status, changed, paths, failed, manifest.version or None, years)

    def commit(self, manifest: vs.Manifest, onto: int | None) -> None:
        vs.commit(self.spark, self.out_dir, manifest, onto)
        vs.remove_old(self.spark, self.out_dir, {"warehouse": 2, "_staging": 1})

    def entry(self, root: str, name: str, schema, kept: list[str] = ()) -> vs.Table:
        """The manifest entry of a table: folders ``kept`` from an earlier version and those of this run."""
        mine = vs.folders(self.spark, self.out_dir, root, name, self.token, name in wh.PARTITIONING)
        return vs.Table(root, [*kept, *mine], schema.json())

    def stage(self, df: DataFrame, name: str) -> vs.Table:
        wh.write_table(df, self.path("_staging"), name, typed=False, version=self.token)
        return self.entry("_staging", name, df.schema)

    def build(self, inputs: Inputs, base: vs.Manifest | None, changed: list[str],
              raw_rows: int) -> tuple[vs.Manifest, int, list[tuple], list[int] | None]:
        """Clean layer, star and checks, all in folders of this run (and those taken over from ``base``)."""
        spark, out = self.spark, vs.Manifest(self.token, {})
        staged = {"clean_ratings": clean.clean_ratings(inputs.ratings), "clean_movies": clean.clean_items(inputs.movies),
                  "clean_tags": clean.clean_tags(inputs.tags)}
        for name, df in staged.items():
            out.tables[name] = self.stage(df, name)
        ratings, items = (out.read(spark, self.out_dir, n) for n in ("clean_ratings", "clean_movies"))

        # An empty fact is an error, checked on the staged layer (cheap limit).
        if wh.fact_base(ratings, items).limit(1).count() == 0:
            raise ValueError("fact_ratings: no rows after cleaning and filtering")

        years, kept = None, {}
        if self.incremental:
            years, tables, kept = self.partial(out, ratings, items, inputs, base, changed)
        else:
            tables = wh.star_tables(ratings, items, inputs.genome_scores, self.params)
        metrics: dict[str, dict] = {}
        wh.write_star({t: tables[t] for t in WAREHOUSE_TABLES if kept.get(t) is not True}, self.path("warehouse"),
                      version=self.token, metrics=metrics, max_records_per_file=self.params.max_records_per_file)
        for t in WAREHOUSE_TABLES:
            out.tables[t] = base.tables[t] if kept.get(t) is True else self.entry("warehouse", t, table_schema(t), kept.get(t, []))
        written = {t: out.read(spark, self.out_dir, t) for t in WAREHOUSE_TABLES}
        for t in kept:                        # partly or wholly an earlier run's: nothing observed all of it
            wanted = qc.write_metrics(WAREHOUSE_NOT_NULL[t], WAREHOUSE_MAX_LENGTHS.get(t, {}), wh.NULL_KEYS.get(t, ()), wh.BOUNDED.get(t))
            metrics[t] = written[t].agg(*[c.alias(n) for n, c in wanted.items()]).first().asDict()
        log, stats = rl.read_log(spark, self.log_path), rl.read_log(spark, self.path("_audit", "pipeline_table_stats"),
                                                                    rl.TABLE_STATS_SCHEMA)
        prev = rl.last_success_stats(log, stats) if log.limit(1).count() else None
        checks, drift = quality_suite(written, raw_rows, prev, metrics, inputs=inputs,
                                      audit={"pipeline_run_log": log, "pipeline_table_stats": stats})
        latest = self.path("_audit", "quality_latest")
        checks.write.mode("overwrite").parquet(latest)
        drift.write.mode("overwrite").parquet(self.path("_audit", "drift_latest"))
        failed = spark.read.parquet(latest).filter((~F.col("passed")) & (F.col("severity") == qc.ERROR)).count()
        return out, failed, [(t, int(metrics[t]["row_count"])) for t in WAREHOUSE_TABLES], years

    def partial(self, out: vs.Manifest, ratings: DataFrame, items: DataFrame, inputs: Inputs, base: vs.Manifest | None,
                changed: list[str]) -> tuple[list[int], Mapping[str, DataFrame], dict]:
        """State by year, and the star from it; ``kept`` has folders of ``base`` (True: the whole table)."""
        spark, params = self.spark, self.params
        out.tables["digests"] = self.stage(year_digests(ratings), "digests")
        digests = out.read(spark, self.out_dir, "digests")
        have = {r[0] for r in digests.select("rating_year").distinct().collect()}
        differ = have
        if base is not None:
            before = base.read(spark, self.out_dir, "digests")
            differ = {r[0] for r in changed_years(digests, before).collect()}
        first = min(differ) if differ else None
        redone = sorted(differ & have)
        some = ratings.filter(F.col("rating_year").isin(redone))
        keep = lambda name, fine: [f for f in base.tables[name].folders if fine(int(f.rsplit("=", 1)[1]))] if base else []
        for name, df in (("item_years", agg.year_totals(some)), ("user_years", some.select("rating_year", "userId").distinct())):
            wh.write_table(df, self.path("_staging"), name, typed=False, version=self.token)
            out.tables[name] = self.entry("_staging", name, df.schema, keep(name, lambda y: y in have and y not in differ))
        totals, users = out.read(spark, self.out_dir, "item_years"), out.read(spark, self.out_dir, "user_years")

        def fact():
            start = F.make_date(F.lit(first), F.lit(1), F.lit(1))
            earlier = ratings.filter((F.col("rating_year") < first) & (F.col("rating_year") >= first - 1 - params.rolling_days // 365)
                                     & (F.col("rating_date") >= F.date_sub(start, params.rolling_days)))
            old = totals.filter(F.col("rating_year") < first).groupBy("movieId").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            return wh.fact_ratings(ratings.filter(F.col("rating_year") >= first), items, rolling_days=params.rolling_days, before=old,
                                   recent=win.daily_totals(earlier, ["movieId"], "rating_date", "rating"))

        def similarity():
            return wh.star_tables(totals, items, inputs.genome_scores, params)["tag_similarity"]

        tables = wh.LazyTables({
            "dim_movies": lambda: wh.dim_movies(items), "dim_users": lambda: wh.dim_users(users), "fact_ratings": fact,
            "genre_trends": lambda: agg.group_trends(totals, items, sort=False),
            "decade_stats": lambda: agg.bucket_stats(totals, items, min_count=params.min_count, sort=False),
            "tag_similarity": similarity})
        kept: dict[str, list[str] | bool] = {}
        if base is not None:
            kept["fact_ratings"] = True if first is None else keep("fact_ratings", lambda y: y < first)
            if params.sim_top_n is None and "genome_scores" not in changed:
                kept["tag_similarity"] = True
        return sorted(differ), tables, kept
