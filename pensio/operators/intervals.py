"""Joining points in time to intervals, and finding the next point, per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pensio.operators.ordering import windowed


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    *,
    key: str,
    point: str,
    lo: str,
    hi: str,
    years: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``points`` with the rows of ``intervals`` of the same key for which lo <= point <= hi.

    Both sides meet on (key, calendar year), so a key with very many rows is spread over its years, each point
    is compared with the intervals of its own year only, and either side of a still heavy year can be split by
    adaptive execution. An interval is repeated only for years in which a point exists; ``years`` may name a
    cheaper DataFrame (first column a date) whose years cover those of ``points``. Intervals with a NULL bound
    or lo > hi hold no point and are dropped before the join.
    """
    source = points.select(point) if years is None else years
    used = source.select(F.year(source.columns[0]).alias("y")).agg(F.collect_set("y"))
    binned = (
        intervals.where(F.col(lo) <= F.col(hi))
        .withColumn("_used", used.scalar())
        .withColumn(
            "_year",
            F.explode(F.filter("_used", lambda y: (y >= F.year(lo)) & (y <= F.year(hi)))),
        )
        .drop("_used")
    )
    return (
        points.withColumn("_year", F.year(point))
        .join(binned, [key, "_year"])
        .where(F.col(point).between(F.col(lo), F.col(hi)))
        .drop("_year")
    )


def asof_join(points: DataFrame, intervals: DataFrame, *, key: str, point: str, lo: str, hi: str) -> DataFrame:
    """As ``interval_join``, for intervals of one key that do not overlap: at most one holds a point.

    That one is the last to start on or before the point. Points and starts form one list by day, cut into months; a
    month that has points gets the interval left open before it, so a key of any size is divided and the points are
    moved and sorted once. What is left open is found from the months alone, at most two rows a key and month.
    """
    beside = [c for c in intervals.columns if c != key]
    given = {key: "_key", point: "_day"}  # the list's own columns, moved once
    more = F.struct(F.lit(1).alias("_is"), *[c for c in points.columns if c not in given])
    starts = intervals.where((F.col(lo) <= F.col(hi)) & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.trunc(lo, "MM").alias("_month"), F.col(lo).alias("_day"),
        F.struct(*beside).alias("_interval"),
    )
    asked = points.where(F.col(point).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.trunc(point, "MM").alias("_month"), F.col(point).alias("_day"),
        more.alias("_point"),
    )
    # Starts of a month come after the question of what was open before it.
    months = asked.select("_key", "_month").distinct().withColumn("_day", F.lit(None).cast("date"))
    so_far = Window.partitionBy("_key").orderBy("_month", F.col("_day").asc_nulls_first())
    left = (
        months.unionByName(starts, allowMissingColumns=True)
        .withColumn("_open", F.last("_interval", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("_day").isNull() & F.col("_open").isNotNull())
        .select("_key", "_month", "_day", F.col("_open").alias("_interval"))
    )
    both = left.unionByName(starts).unionByName(asked, allowMissingColumns=True)
    # By day: what was left open, a start, the points.
    order = [F.col("_day").asc_nulls_first(), F.col("_point").isNotNull()]
    inside = Window.partitionBy("_key", "_month").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("_held", F.last("_interval", ignorenulls=True).over(inside))
    return placed.where(F.col("_point").isNotNull() & (F.col("_day") <= F.col(f"_held.{hi}"))).select(
        *[F.col(given.get(c, f"_point.{c}")).alias(c) for c in points.columns], "_held.*"
    )


def next_on_or_after(
    days: DataFrame, marks: DataFrame, *, key: str, day: str, mark: str, out: str
) -> DataFrame:
    """(key, day, out): for each distinct (key, day) the first mark of that key on or after the day.

    Both inputs are reduced to distinct calendar days before they are brought together, so a key never holds
    more than two rows per calendar day, however many rows it has in the inputs.
    """
    asked = days.where(F.col(day).isNotNull()).select(key, F.col(day).alias("_day"))
    given = marks.where(F.col(mark).isNotNull()).select(key, F.col(mark).alias("_day"))
    both = (
        asked.distinct()
        .withColumn("_mark", F.lit(None).cast("date"))
        .unionByName(given.distinct().withColumn("_mark", F.col("_day")))
    )
    # Backwards in time, a mark before the questions of its own day: the last mark seen is the next one.
    backwards = (
        Window.partitionBy(key)
        .orderBy(F.col("_day").desc(), F.col("_mark").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        both.withColumn(out, F.last("_mark", ignorenulls=True).over(backwards))
        .where(F.col("_mark").isNull())
        .select(key, F.col("_day").alias(day), out)
    )


def count_in_ranges(
    ranges: DataFrame, marks: DataFrame, *, key: str, lo: str, hi: str, mark: str, out: str
) -> DataFrame:
    """``ranges`` with the number of distinct marks of the key in lo..hi; 0 where a bound is NULL or lo > hi.

    The marks up to a day are counted once per key and day asked for, over one list of distinct days cut into years;
    a range's number is that of its end less that of the day before its start. Ranges never meet marks. ``ranges`` is
    read more than once: pass a table or a staged result.
    """
    bounded = F.col(lo) <= F.col(hi)
    before = F.when(bounded, F.date_sub(lo, 1))
    asked = ranges.where(bounded).select(key, F.explode(F.array(before, F.col(hi))).alias("_day"))
    given = (
        marks.where(F.col(mark).isNotNull())
        .join(asked.select(key), key, "left_semi")
        .select(key, F.col(mark).alias("_day"))
    )
    days = (
        asked.withColumn("_marked", F.lit(0))
        .unionByName(given.withColumn("_marked", F.lit(1)))
        .groupBy(key, "_day")
        .agg(F.max("_marked").alias("_marked"))
    )
    ranked = windowed(days, [key], ["_day"], bucket=[F.year("_day")], sums={"_rank": "_marked"})

    def rank(name: str) -> DataFrame:
        return ranked.select(F.col(key).alias(f"{name}_key"), F.col("_day").alias(f"{name}_day"), F.col("_rank").alias(name))

    met = ranges.join(rank("_below"), (F.col(key) == F.col("_below_key")) & (before == F.col("_below_day")), "left").join(
        rank("_upto"), (F.col(key) == F.col("_upto_key")) & bounded & (F.col(hi) == F.col("_upto_day")), "left"
    )
    return met.select(*ranges.columns, F.coalesce(F.col("_upto") - F.col("_below"), F.lit(0)).alias(out))
