"""Row-changing statements as whole-snapshot transformations.

Parquet tables cannot be changed in place. Each function here reads one snapshot and describes the next; writing
it to a new location is the caller's step (``sources.tables.publish``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pensio.operators.ordering import numbered


def update_where(
    target: DataFrame,
    assigns: Mapping[str, Column],
    *,
    keys: DataFrame | None = None,
    on: list[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """UPDATE target SET assigns WHERE (on) IN (keys) AND where.

    ``keys`` carries columns named as ``on``; repeated and NULL keys are harmless.
    """
    hit = F.lit(True) if where is None else where
    frame = target
    if keys is not None:
        listed = keys.select(*on).dropna().distinct().withColumn("_hit", F.lit(True))
        frame = target.join(listed, on, "left")
        hit = hit & F.col("_hit")
    return frame.select(
        *[F.when(hit, assigns[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
          if c in assigns else F.col(c) for c in target.columns]
    )


def delete_where(target: DataFrame, predicate: Column | None = None) -> DataFrame:
    """DELETE FROM target WHERE predicate: rows for which it is unknown stay. No predicate empties the table."""
    keep = F.lit(False) if predicate is None else ~F.coalesce(predicate, F.lit(False))
    return target.where(keep)


def delete_by_key(target: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """DELETE FROM target WHERE (on) IN (keys)."""
    return target.join(keys.select(*on), on, "left_anti")


def merge_insert_only(target: DataFrame, source: DataFrame, on: list[str], ids: str | None = None,
                      first_id: int = 1) -> DataFrame:
    """MERGE that only inserts: source rows whose key is not in the target are appended.

    With ``ids`` the appended rows get new numbers in that column, from ``first_id`` on in key order. Columns the
    source lacks become NULL.
    """
    new = source.join(target.select(*on), on, "left_anti")
    if ids:
        new = with_ids(new, ids, on, first_id)
    return target.unionByName(new, allowMissingColumns=True)


def multi_insert(source: DataFrame, *projections: list[Column]) -> tuple[DataFrame, ...]:
    """INSERT ALL: each source row into several targets, one projection per target."""
    return tuple(source.select(*columns) for columns in projections)


def with_ids(df: DataFrame, name: str, order: list[str], first_id: int = 1) -> DataFrame:
    """Consecutive new ids in the given order, which must tell the rows apart; no task sees more than a piece."""
    base = df.drop(name) if name in df.columns else df
    columns = df.columns if name in df.columns else [name, *df.columns]
    placed = numbered(base, order, name)
    return placed.withColumn(name, F.col(name) + F.lit(first_id - 1).cast("long")).select(*columns)


def apply_corrections(
    target: DataFrame, corrections: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """New column values by key, from a corrections table that holds each key once.

    A NULL correction leaves the old value, unless a boolean column ``set_<column>`` says that NULL is meant.
    """
    flags = [c for c in (f"set_{c}" for c in columns) if c in corrections.columns]
    new = corrections.select(
        key, *[F.col(c).alias(f"_new_{c}") for c in columns], *[F.col(c).alias(f"_{c}") for c in flags]
    )
    joined = target.join(new, key, "left")

    def value(c):
        given = F.coalesce(F.col(f"_new_{c}"), F.col(c))
        if f"set_{c}" in flags:
            given = F.when(F.col(f"_set_{c}"), F.col(f"_new_{c}")).otherwise(given)
        return given.cast(target.schema[c].dataType).alias(c)

    return joined.select(*[value(c) if c in columns else F.col(c) for c in target.columns])
