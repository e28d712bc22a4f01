"""Numbering, counting and neighbour access inside groups, of which a few may be very large.

A window sends all rows of a key to one task. Here a key is cut along the window's own order into buckets that the caller
names (a year, a day, a range of numbers). Rows are numbered inside their bucket; one summary row per key and bucket
gives what lies before and after it. So a task sees one bucket of a key, or the bucket list of a key, never a whole key.
Rows are moved once, to their bucket; numbering and summary both read that exchange, so windows may be nested.
There is one plan for keys of any size, built without running a job, and its results are those of the plain window.

Without keys the whole input is one group: it is cut into even range pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pensio.functions.semantics import asc
from pensio.sources.snapshots import stage


def windowed(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    bucket: list[Column],
    rn: str | None = None,
    cnt: str | None = None,
    lead: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
    sums: dict[str, str] | None = None,
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """``df`` with row_number, count, lead, lag and what came so far over (partition by keys order by order).

    ``rn`` and ``cnt`` name result columns. ``lead``, ``lag``, ``sums`` and ``carry`` map result names to columns: the
    sum and the last value that is not NULL, both up to and with the row. The order is
    ascending with NULLs last and must tell the rows of a key apart; NULL keys form one group. ``bucket`` are
    expressions that never decrease along the order; rows of a key with equal ones should fit a task.
    """
    lead, lag, sums, carry = lead or {}, lag or {}, sums or {}, carry or {}
    names = [f"_b{i}" for i in range(len(bucket))]
    frame = df.withColumns(dict(zip(names, bucket)))
    group = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([*keys, *names])])
    # Both uses of the rows below start from this one exchange. They sort by every column, ties of the order included,
    # so that neither use needs fewer columns than the other: the planner then reads the exchange twice and fills it once.
    shared = frame.withColumn("_group", group).repartition("_group")
    inside = Window.partitionBy("_group").orderBy(*asc(*order, *[c for c in df.columns if c not in order]))
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = {"_n": F.row_number().over(inside), "_end": F.lead(F.lit(1)).over(inside).isNull()}
    # A neighbour may be NULL: whether there is one is told apart from its value.
    own |= {f"_in_{n}": F.lead(F.struct(c)).over(inside) for n, c in lead.items()}
    own |= {f"_in_{n}": F.lag(F.struct(c)).over(inside) for n, c in lag.items()}
    own |= {f"_head_{n}": F.first(c).over(whole) for n, c in lead.items()}
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own |= {f"_sum_{n}": F.sum(c).over(so_far) for n, c in sums.items()}
    own |= {f"_open_{n}": F.last(c, ignorenulls=True).over(so_far) for n, c in carry.items()}
    numbered = shared.withColumns(own)
    # A bucket's last row tells how many it has.
    along = Window.partitionBy(*[f"_group.k{i}" for i in range(len(keys))]).orderBy(
        *[F.col(f"_group.k{len(keys) + i}").asc_nulls_last() for i in range(len(names))]
    )
    everything = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    summary = numbered.where("_end").select(
        F.col("_group").alias("_bucket"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("_total"),
        *[F.lead(f"_head_{n}").over(along).alias(f"_next_{n}") for n in lead],
        *[F.lag(c).over(along).alias(f"_last_{n}") for n, c in lag.items()],
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_until_{n}") for n in sums],
        *[F.last(f"_open_{n}", ignorenulls=True).over(earlier).alias(f"_left_{n}") for n in carry],
    )
    met = numbered.join(summary, F.col("_group") == F.col("_bucket"))
    new = {n: F.when(F.col(f"_in_{n}").isNotNull(), F.col(f"_in_{n}")[c]).otherwise(F.col(f"_next_{n}")) for n, c in lead.items()}
    new |= {n: F.when(F.col(f"_in_{n}").isNotNull(), F.col(f"_in_{n}")[c]).otherwise(F.col(f"_last_{n}")) for n, c in lag.items()}
    new |= {n: F.coalesce(f"_sum_{n}", F.lit(0)) + F.col(f"_until_{n}") for n in sums}
    new |= {n: F.coalesce(f"_open_{n}", f"_left_{n}") for n in carry}
    if rn:
        new[rn] = F.col("_before") + F.col("_n")
    if cnt:
        new[cnt] = F.col("_total")
    return met.select(*df.columns, *[v.alias(n) for n, v in new.items()])


def in_pieces(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in even range pieces of the order, with each row's piece and a number that rises inside it.

    Write the result before ``place_in_pieces``: counting and numbering must see the same pieces.
    """
    along = asc(*order)
    return (
        df.repartitionByRange(*along)
        .sortWithinPartitions(*along)
        .withColumns({"_piece": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )


def place_in_pieces(written: DataFrame, name: str, first: int = 1) -> DataFrame:
    """``written`` (with ``_piece`` and ``_at``) with each row's number in the order, from ``first`` on.

    The pieces are counted from their two columns alone; their list has one row a piece and is sent to every task, so
    the rows themselves stay where they are.
    """
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        written.groupBy("_piece")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .select("_piece", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.col("_before") + F.col("_at") - F.col("_first") + F.lit(first).cast("long")
    return written.join(F.broadcast(pieces), "_piece").withColumn(name, place)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the place of each row in the order, which must tell the rows apart; no task sees more than a piece."""
    return place_in_pieces(stage(in_pieces(df, order)), name).select(*df.columns, name)


def rank(order: list[str]) -> Column:
    """A value that sorts as ``order`` does: ascending, NULLs last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
