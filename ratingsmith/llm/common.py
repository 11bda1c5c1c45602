"""Shared helpers of the text operators: tables, staged results, packed exchange, links.

Staged results are Parquet folders below ``spark.checkpoint.dir`` (see
``ratingsmith.session.workspace``), so they survive lost executors and can be
read by all of them.
"""

from __future__ import annotations

import ctypes
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratingsmith.session import ensure_checkpoint_dir, workspace

#: Rows of one Arrow batch: texts of any length travel a few MB at a time.
ARROW_ROWS = 1000

#: The word pattern shared by all operators: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def release_memory() -> None:
    """Give freed memory back to the system; Python workers stay alive between tasks and would hold it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(run):
    """``run`` for ``mapInArrow``, releasing memory when a task ends."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return task


def map_group(run):
    """``run`` for ``applyInArrow``, releasing memory after a group."""
    def group(tbl: pa.Table) -> pa.Table:
        out = run(tbl)
        del tbl
        release_memory()
        return out
    return group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower Spark's Arrow batch size, unless the session already has a lower one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


class Stages:
    """Intermediate tables of one operator call, written once and read back.

    ``drop`` deletes a table that nothing reads any more; what the returned
    DataFrame reads must stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark, self.names = spark, set()
        self.root = workspace(spark, "llm", f"{name}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.names.discard(name)

    def drop_others(self, *kept: str) -> None:
        for name in self.names - set(kept):
            self.drop(name)


def placed(df: DataFrame, stages: Stages, name: str, place: str = "place") -> DataFrame:
    """``df`` with a gapless number from 0 along its partitions and the rows in them, staged as ``name``.

    After ``repartitionByRange`` and ``sortWithinPartitions`` it is the place in the global order.
    No row moves: a task numbers its own rows, and only one row a task is summed up.
    """
    done = stages.put(df.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    counts = done.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    first = F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")
    parts = stages.put(counts.select("_part", first.alias("_first")), f"{name}_parts")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (done.withColumn("_part", part).join(parts, "_part")
            .withColumn(place, F.col("_first") + inside).drop("_part", "_at", "_first"))


#: Hash buckets of a packed exchange.  A task sends one row a bucket, so more of them would
#: leave a few entries in each row; beyond that the buckets grow instead (at 100 TB of text to
#: some 20 million entries, below 1 GB in a task).
BUCKETS = 200_000


def parts(spark: SparkSession, items: float, per_part: float) -> int:
    """Hash buckets so that each holds about ``per_part`` items, and no fewer than shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(BUCKETS, math.ceil(items / per_part)), 1)


def text_bytes(df: DataFrame, text: str | Column) -> int:
    """Exact number of text bytes, for sizing buckets only."""
    col = F.col(text) if isinstance(text, str) else text
    return int(df.agg(F.sum(F.octet_length(col))).first()[0] or 0)


def text_key(text: str | Column) -> Column:
    """64-bit key of a text; NULL counts as the empty text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(col, F.lit("")))


#: Keys of colliding texts that may reach the driver.  Chance gives some 3 among 10^10 distinct texts, 270 among 10^11.
TWINS = 10_000


def distinct_key(df: DataFrame, text: str) -> Column:
    """A 64-bit key, ``text_key`` for nearly all texts, in which no two different texts of ``df`` agree.

    One aggregate over (key, hash of the SHA-256) finds the keys that different texts share; their texts get
    another key from the SHA-256.  Collisions of ``text_key`` can be constructed, so there may be any number of
    them: beyond TWINS all texts take the other key, whose collisions come by chance alone.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    key, other, salt = text_key(text), F.xxhash64(F.lit(1), digest), 1
    while True:
        sides = df.select(key.alias("k"), other.alias("o")).groupBy("k").agg(F.min("o").alias("lo"), F.max("o").alias("hi"))
        twins = [r["k"] for r in sides.filter("lo <> hi").select("k").limit(TWINS + 1).collect()]
        if not twins:
            return key
        salt += 1
        fresh = F.xxhash64(F.lit(salt), digest)
        key = fresh if len(twins) > TWINS else F.when(key.isin(twins), fresh).otherwise(key)


def bounded_sample(df: DataFrame, group: str, order: str, most: int, stages: Stages) -> DataFrame:
    """The first ``most`` rows of each group by ``order`` (a 64-bit hash column), whatever the input's size.

    Rows beyond twice the expected share are dropped by their hash before anything is
    shuffled, so the ranking sees about ``2 * most`` rows a group.  (For ``most`` in
    the hundreds or more, fewer than ``most`` would pass only by a freak of the hash.)
    """
    sizes = stages.put(df.groupBy(group).agg(F.count("*").alias("_rows")), "group_sizes")
    share = F.col(order).cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    few = df.join(sizes, group).filter(share * F.col("_rows") <= F.lit(2.0 * most)).drop("_rows")
    rank = F.row_number().over(W.partitionBy(group).orderBy(order))
    return few.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


#: Bits of a key bitmap (8 MB): a fixed size that is sent to every task.
KEY_BITS = 26


def key_bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the low KEY_BITS bits of ``k``; built in Spark, at most 8 MB reach the driver.

    It tells most texts without a partner from the others before anything is shuffled.
    A full bitmap only saves less; what passes is joined exactly.
    """
    at = F.pmod("k", F.lit(1 << KEY_BITS)) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m"))
    out = np.zeros((1 << KEY_BITS) // 8, np.uint8)
    for r in rows.collect():
        out[(r.b - 1) * 4096:r.b * 4096] = np.frombuffer(r.m, np.uint8)
    return out


def listed(bitmap: np.ndarray, k: np.ndarray) -> np.ndarray:
    at = k.astype(np.int64).view(np.uint64) & np.uint64((1 << KEY_BITS) - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def only_listed(sent):
    """Batches without the rows whose ``k`` is certainly not in the broadcast bitmap."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(listed(sent.value, np.asarray(batch["k"]))))
    return run


def connected_components(edges: DataFrame, stages: Stages, tag: str = "cc") -> DataFrame:
    """``(a, b)`` links -> ``(node, root)`` with root the smallest node reachable.

    Every round maps each node to its smallest neighbour and rewrites the links
    between those, so a star of any size collapses in one round.  Only partial
    aggregates and splittable joins against staged tables are used; the driver
    sees one count a round.  Nodes without a link get no row.  NULL ends are
    dropped.
    """
    now = stages.put(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                     .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), f"{tag}_e0")
    maps: list[DataFrame] = []
    while not now.isEmpty():
        k = len(maps)
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stages.put(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select("a", F.least("a", "m").alias("up")), f"{tag}_m{k}")
        maps.append(up)
        left = up.select(F.col("a"), F.col("up").alias("ua"))
        right = up.select(F.col("a").alias("b"), F.col("up").alias("ub"))
        now = stages.put(now.join(left, "a").join(right, "b")
                         .filter("ua <> ub")
                         .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
                         .distinct(), f"{tag}_e{k + 1}")
    if not maps:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    done = maps[-1].select(F.col("a").alias("node"), F.col("up").alias("root"))
    for k in range(len(maps) - 2, -1, -1):
        nxt = done.select(F.col("node").alias("up"), F.col("root"))
        done = stages.put(maps[k].join(nxt, "up", "left")
                          .select(F.col("a").alias("node"), F.coalesce("root", "up").alias("root")),
                          f"{tag}_r{k}")
    return done


def others(df: DataFrame, *used: str) -> Column:
    """All columns of ``df`` but ``used`` as one struct, so that no name can clash with an operator's own."""
    return F.struct(F.lit(True).alias("_"), *(df[quoted(c)].alias(c) for c in df.columns if c not in used))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def restore(df: DataFrame, done: DataFrame, results: dict[str, str]) -> DataFrame:
    """Columns of ``df`` from the struct ``row``, with ``results`` (name -> column of ``done``).

    A result takes the place of an input column of its name; the rest follow at the end.
    """
    cols = [F.col(results[c]).alias(c) if c in results else F.col("row").getField(c).alias(c) for c in df.columns]
    cols += [F.col(src).alias(c) for c, src in results.items() if c not in df.columns]
    return done.select(*cols)
