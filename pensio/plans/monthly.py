"""An import of many months as a job over its control table, which says what is new, in work and complete.

The month is the unit. A step claims months (state W), runs them, and completes them (state C); each is one new snapshot
of the control table or one replacement of the months' results, so a job can be stopped anywhere and started again: a
month found claimed is run again and its results replaced, a complete one is not touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pensio import schemas
from pensio.operators.rows import update_where
from pensio.sources.runs import RunTable

# States of a control row.
NEW, WORKING, COMPLETE = "N", "W", "C"
MONTH = "pay_month"


def month_number(day: str) -> Column:
    """The month of a day as a number, year before month."""
    return F.year(day) * 100 + F.month(day)


@dataclass(frozen=True)
class ControlTable:
    """Snapshots of ``transform_pa_assignments`` under ``path``, the last complete one being the table."""

    spark: SparkSession
    path: str

    def _version(self, number: int) -> str:
        return f"{self.path.rstrip('/')}/v={number:08d}"

    def latest(self) -> int:
        """The number of the last complete snapshot, 0 before the first one."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        numbers = sorted((int(n[2:]) for n in names if n.startswith("v=")), reverse=True)
        return next((n for n in numbers if fs.exists(hadoop.Path(f"{self._version(n)}/_SUCCESS"))), 0)

    def read(self) -> DataFrame:
        return self.spark.read.schema(schemas.schema("transform_pa_assignments")).parquet(self._version(self.latest()))

    def write(self, rows: DataFrame) -> None:
        """The next snapshot; one that a stopped job left incomplete is replaced."""
        declared = schemas.schema("transform_pa_assignments").fields
        rows.select(*[F.col(f.name).cast(f.dataType) for f in declared]).write.mode("overwrite").parquet(
            self._version(self.latest() + 1)
        )


def _marked(rows: DataFrame, months: list[int], state: str, now: dt.datetime) -> DataFrame:
    new = {"state": F.lit(state), "last_update_date": F.lit(now)}
    return update_where(rows, new, where=month_number("date_op").isin(months))


def import_months(
    control: ControlTable,
    results: RunTable,
    work: Callable[[DataFrame], DataFrame],
    now: Callable[[], dt.datetime],
    *,
    at_once: int = 1,
    steps: int | None = None,
) -> list[int]:
    """Runs the months that are not complete, claimed ones first, then by date; gives those it completed.

    ``work`` turns the control rows of claimed months into result rows with their month in ``pay_month``, by which
    ``results`` is kept. A month is complete when all its rows are; one that is not is run whole. ``at_once`` months
    share a step; ``steps`` may end the job after that many.
    """
    done: list[int] = []
    while steps is None or steps > 0:
        rows = control.read()
        waiting = (
            rows.groupBy(month_number("date_op").alias("month"))
            .agg(F.max(F.col("state") == WORKING).alias("claimed"), F.min(F.col("state") == COMPLETE).alias("complete"))
            .where("not complete")
            .orderBy(F.desc("claimed"), "month")
            .limit(at_once)
        )
        months = [r.month for r in waiting.collect()]
        if not months:
            break
        control.write(_marked(rows, months, WORKING, now()))
        claimed = control.read()
        results.delete(months)  # what a stopped run may have left
        results.replace(work(claimed.where(month_number("date_op").isin(months))))
        control.write(_marked(claimed, months, COMPLETE, now()))
        done += months
        steps = None if steps is None else steps - 1
    return done
