"""Running and rolling statistics per entity.

A plain ``Window.partitionBy(item)`` sends every row of an item to one task, so
an item holding a third of the data becomes one straggler.  Here:

* day-range statistics (``RANGE BETWEEN n DAYS PRECEDING AND CURRENT ROW``) alone never
  window the rows: rows are summed up per (entity, day) with a partial aggregate,
  the window runs over those daily totals (one row per calendar day), and the rows
  get their day's frame by a join on (entity, day);
* running statistics window the rows once, partitioned by ``(entity, group)``.  The
  group is empty for an entity with at most ``hot_rows`` rows, so its partition is
  the plain per-entity window; for a hot entity it is ``order[:-1]`` (day, second),
  and the totals of all earlier groups come from partial aggregates rolled up level
  by level with windows over those small tables;
* both together move the rows once, by (entity, group): with an empty group the day
  range is a second window over the same sorted rows, and a hot entity's groups get
  their day's frame, from daily totals, beside their earlier totals.  All that is
  joined to the rows is keyed by (entity, group), so the rows stay where they are.

Both forms give the result of the plain window ``ORDER BY order`` for any
``hot_rows``, as long as ``partition + order`` is unique; ``hot_rows`` moves work
only.  Keys are compared as structs, so a NULL entity is an entity like any other
and a NULL order value sorts first, in either form: a NULL date has a frame of the
NULL dates only, as in SQL.  The list of hot entities is broadcast from ``BROADCAST_HOT_ROWS``
on, as it has at most one entity for so many rows; else the rows stream past a hashed
list.  The other sides are grouped keys, and Spark's own size check decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingsmith.functions import day_number, half_up, safe_divide

_C, _S = "_rs_cnt", "_rs_sum"
_ENTITY, _GROUP, _DAY = "_rs_entity", "_rs_group", "_rs_day"

# Entities with more rows than this are split in running windows.
DEFAULT_HOT_ROWS = 2_000_000
# From this many rows on the entities that are split are few enough to broadcast.
BROADCAST_HOT_ROWS = 500_000


def _totals(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(measure).alias(_C),
                                 F.sum(F.col(measure).cast("double")).alias(_S))


def _key(cols: Sequence[str]) -> Column:
    """A NULL-safe key: structs with NULL fields compare as equal."""
    return F.struct(*[F.col(c) for c in cols])


def _earlier_totals(groups: DataFrame, partition: Sequence[str], upper: Sequence[str]) -> DataFrame:
    """``entity, group, _off_c, _off_s``: totals of all rows ordered before each group.

    ``groups`` has one row per entity and ``upper`` values; coarser levels are rolled
    up from it, never from the rows.
    """
    acc = None
    for i, col in enumerate(upper):
        outer = [*partition, *upper[:i]]
        level = groups if i == len(upper) - 1 else groups.groupBy(*outer, col).agg(
            F.sum(_C).alias(_C), F.sum(_S).alias(_S))
        before = Window.partitionBy(*outer).orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(*outer, col, F.coalesce(F.sum(_C).over(before), F.lit(0)).alias(f"_c{i}"),
                             F.coalesce(F.sum(_S).over(before), F.lit(0.0)).alias(f"_s{i}"))
        if acc is None:
            acc = level
        else:
            prev = acc.select(_key(outer).alias("_k"), *[c for c in acc.columns if c not in outer])
            acc = level.withColumn("_k", _key(outer)).join(prev, "_k", "left").drop("_k")
    plus = lambda p: sum((F.col(f"{p}{i}") for i in range(1, len(upper))), F.col(f"{p}0"))
    return acc.select(_key(partition).alias(_ENTITY), _key(upper).alias(_GROUP), plus("_c").alias("_off_c"),
                      plus("_s").alias("_off_s"))


def _daily_frames(daily: DataFrame, date_col: str, days: int, recent: DataFrame | None = None) -> DataFrame:
    """``entity, day, _roll_c, _roll_s``: totals of the days ``[day - days, day]``; ``recent`` has more daily totals."""
    if recent is not None:
        older = recent.select(_ENTITY, day_number(date_col).alias(_DAY), F.col("n").alias(_C), F.col("total").alias(_S))
        daily = daily.unionByName(older).groupBy(_ENTITY, _DAY).agg(F.sum(_C).alias(_C), F.sum(_S).alias(_S))
    frame = Window.partitionBy(_ENTITY).orderBy(_DAY).rangeBetween(-days, 0)
    return daily.select(_ENTITY, F.struct(_DAY).alias(_DAY), F.sum(_C).over(frame).alias("_roll_c"),
                        F.sum(_S).over(frame).alias("_roll_s"))


def entity_stats(df: DataFrame, partition: Sequence[str], order: Sequence[str], measure: str,
                 running: tuple[str, str] | None = ("cumulative_rating_count",
                                                    "cumulative_avg_rating"),
                 rolling: tuple[str, str] | None = None, rolling_days: int = 30,
                 scale: int = 2, hot_rows: int | None = DEFAULT_HOT_ROWS,
                 before: DataFrame | None = None, recent: DataFrame | None = None,
                 sized: DataFrame | None = None) -> DataFrame:
    """Append running and/or day-range rolling count and average columns.

    Rows that are ordered before all of ``df``'s rows of an entity may be given as state instead:
    ``before`` has their totals (``partition``, ``n``, ``total``), ``recent`` the daily totals of at
    least the last ``rolling_days`` days (``daily_totals``).

    ``order[0]`` must be a DATE column when ``rolling`` is requested; the rolling
    frame covers ``[order[0] - rolling_days, order[0]]`` inclusive and includes
    every row of the same day.  ``hot_rows=None`` splits every entity.

    The rows are read once per part of the result (counts, hot groups, rows): pass a staged
    table where ``df`` is costly to compute, or as ``sized`` a cheaper one with the same entities'
    rows, and maybe more, from which only the entities' sizes are taken.
    """
    partition, order = list(partition), list(order)
    keyed = lambda d: None if d is None else d.withColumn(_ENTITY, _key(partition))
    rows, recent = keyed(df), keyed(recent)
    average = lambda total, count: half_up(safe_divide(total, count), scale)
    out_cols = [F.col(c) for c in df.columns]
    if running is None:
        daily = _totals(rows.select(_ENTITY, day_number(order[0]).alias(_DAY), measure), [_ENTITY, _DAY], measure)
        frames = _daily_frames(daily, order[0], rolling_days, recent)
        rows = rows.withColumn(_DAY, F.struct(day_number(order[0]).alias(_DAY))).join(frames, [_ENTITY, _DAY], "left")
        return rows.select(*out_cols, F.col("_roll_c").cast("bigint").alias(rolling[0]),
                           average(F.col("_roll_s"), F.col("_roll_c")).alias(rolling[1]))

    upper = order[:-1]
    if not upper:
        raise ValueError("running statistics need at least two order columns to split groups")
    hot, moved = rows, rows
    if rolling is not None:
        moved = moved.select("*", F.col(measure).isNotNull().cast("bigint").alias(_C), F.col(measure).cast("double").alias(_S))
        if recent is not None:      # days of the state are in the frames, but are no rows of the result
            state = recent.select(_ENTITY, order[0], F.col("n").alias(_C), F.col("total").alias(_S), F.lit(True).alias("_state"))
            moved = moved.withColumn("_state", F.lit(False)).unionByName(state, allowMissingColumns=True)
    if hot_rows is None:
        moved = moved.withColumn(_GROUP, _key(upper))
    else:
        large = keyed(df if sized is None else sized).groupBy(_ENTITY).agg(
            F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).hint(
            "broadcast" if hot_rows >= BROADCAST_HOT_ROWS else "shuffle_hash")
        moved = moved.join(large, _ENTITY, "left").withColumn(
            _GROUP, F.when(F.col("_n").isNotNull(), _key(upper))).drop("_n")
        hot = rows.join(large, _ENTITY, "left_semi")
    by = order
    if rolling is not None:         # the axis of the day range, so that both windows need one sort
        moved, by = moved.withColumn(_DAY, day_number(order[0])), [_DAY, *order[1:]]
    moved = moved.repartition(_ENTITY, _GROUP)

    # Grouped by the columns, not by the struct that was joined: a hot entity's groups spread over the tasks.
    groups = _totals(hot, [*partition, *upper], measure)
    sides = _earlier_totals(groups, partition, upper)
    if rolling is not None:
        daily = groups.groupBy(_key(partition).alias(_ENTITY), day_number(order[0]).alias(_DAY)).agg(
            F.sum(_C).alias(_C), F.sum(_S).alias(_S))
        frames = _daily_frames(daily, order[0], rolling_days, recent).withColumnsRenamed(
            {"_roll_c": "_day_c", "_roll_s": "_day_s"})
        sides = sides.withColumn(_DAY, F.struct(day_number(F.col(_GROUP)[order[0]]).alias(_DAY))).join(
            frames, [_ENTITY, _DAY], "left").drop(_DAY)

    within = Window.partitionBy(_ENTITY, _GROUP).orderBy(*by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    moved = moved.select("*", F.count(measure).over(within).alias("_run_c"),
                         F.sum(F.col(measure).cast("double")).over(within).alias("_run_s"))
    if rolling is not None:
        frame = Window.partitionBy(_ENTITY, _GROUP).orderBy(_DAY).rangeBetween(-rolling_days, 0)
        moved = moved.select("*", F.sum(_C).over(frame).alias("_roll_c"), F.sum(_S).over(frame).alias("_roll_s"))
        if recent is not None:
            moved = moved.filter(~F.col("_state"))
    moved = moved.join(sides, [_ENTITY, _GROUP], "left")
    count = F.col("_run_c") + F.coalesce("_off_c", F.lit(0))
    total = F.coalesce("_run_s", F.lit(0.0)) + F.coalesce("_off_s", F.lit(0.0))
    if before is not None:
        state = before.select(_key(partition).alias(_ENTITY), F.col("n").alias("_bef_c"), F.col("total").alias("_bef_s"))
        moved = moved.join(state, _ENTITY, "left")
        count = count + F.coalesce("_bef_c", F.lit(0))
        total = total + F.coalesce("_bef_s", F.lit(0.0))
    out_cols += [count.cast("bigint").alias(running[0]), average(total, count).alias(running[1])]
    if rolling is not None:
        of_day = lambda plain, hot: F.when(F.col(_GROUP).isNull(), F.col(plain)).otherwise(F.col(hot))
        c, t = of_day("_roll_c", "_day_c"), of_day("_roll_s", "_day_s")
        out_cols += [c.cast("bigint").alias(rolling[0]), average(t, c).alias(rolling[1])]
    return moved.select(*out_cols)


def daily_totals(df: DataFrame, partition: Sequence[str], date_col: str, measure: str) -> DataFrame:
    """``partition, date_col, n, total``: the state that ``extend_stats`` goes on from."""
    return _totals(df, [*partition, date_col], measure).withColumnsRenamed({_C: "n", _S: "total"})


def merge_daily(a: DataFrame, b: DataFrame, partition: Sequence[str], date_col: str) -> DataFrame:
    """State of both sets of rows."""
    return a.unionByName(b).groupBy(*partition, date_col).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def extend_stats(done: DataFrame, daily: DataFrame, new: DataFrame, partition: Sequence[str], order: Sequence[str],
                 measure: str, running: tuple[str, str] = ("cumulative_rating_count", "cumulative_avg_rating"),
                 rolling: tuple[str, str] = ("rolling_30d_count", "rolling_30d_avg"), rolling_days: int = 30,
                 scale: int = 2, hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """``entity_stats`` of old and new rows together, from the old result and its state.

    ``done`` is the result for the old rows and ``daily`` their ``daily_totals``.  Of an entity with new
    rows, only those from its earliest new day on are worked out again, whether the new rows are late or not; what
    lies before enters as totals, and the last ``rolling_days`` days as daily totals.  All other rows
    pass through without a shuffle of their own (one join on the entity, against one row for each
    entity with new rows).  A NULL date sorts first, so a new one has all its entity's rows worked out again.
    """
    partition, order = list(partition), list(order)
    day = order[0]
    since = new.groupBy(_key(partition).alias(_ENTITY)).agg(
        F.min(day).alias("_from"), F.coalesce(F.bool_or(F.col(day).isNull()), F.lit(False)).alias("_all"))
    later = F.coalesce(F.col("_all") | (F.col(day) >= F.col("_from")), F.lit(False))
    flagged = done.withColumn(_ENTITY, _key(partition)).join(since, _ENTITY, "left")
    rows = flagged.filter(later).select(*new.columns).unionByName(new)
    state = daily.withColumn(_ENTITY, _key(partition)).join(since, _ENTITY).filter(~later)
    before = state.groupBy(*partition).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    recent = state.filter(F.col(day) >= F.date_sub("_from", rolling_days)).select(*partition, day, "n", "total")
    sized = done.select(*partition).unionByName(new.select(*partition))
    again = entity_stats(rows, partition, order, measure, running, rolling, rolling_days, scale, hot_rows, before, recent, sized)
    return flagged.filter(~later).select(*done.columns).unionByName(again.select(*done.columns))


def running_stats(df: DataFrame, partition: Sequence[str], order: Sequence[str], measure: str,
                  count_name: str = "cumulative_rating_count",
                  avg_name: str = "cumulative_avg_rating", scale: int = 2,
                  hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """Running count and average ordered by ``order``."""
    return entity_stats(df, partition, order, measure, running=(count_name, avg_name),
                        scale=scale, hot_rows=hot_rows)


def rolling_stats(df: DataFrame, partition: Sequence[str], date_col: str, measure: str,
                  days: int = 30, count_name: str = "rolling_30d_count",
                  avg_name: str = "rolling_30d_avg", scale: int = 2) -> DataFrame:
    """Count and average over ``[date - days, date]`` per partition (W3, W4), from daily totals."""
    return entity_stats(df, partition, [date_col], measure, running=None,
                        rolling=(count_name, avg_name), rolling_days=days, scale=scale)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_name: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``order``.

    ``row_number() <= k`` lets Catalyst insert a partial group limit before the
    shuffle, so at most ``k`` rows per group and input partition move.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= k)
