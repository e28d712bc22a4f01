"""The monthly import: stops anywhere, repeats no month, loses none."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pensio.plans import monthly, reports
from pensio.sources.runs import RunTable

D = dt.date
MONTHS = [201801, 201802, 201803, 201804]
RESULT = T.StructType(
    [T.StructField("date_op", T.DateType()), T.StructField("ssylka_doc", T.LongType()), T.StructField("pay_month", T.IntegerType())]
)


@pytest.fixture
def job(spark, table, tmp_path):
    control = monthly.ControlTable(spark, str(tmp_path / "control"))
    rows = [(m, k, "C" if m == 1 and k == 1 else "N") for m in range(1, 5) for k in (1, 2)]
    control.write(
        table("transform_pa_assignments", *[
            dict(date_op=D(2018, m, 10), ssylka_doc=k, fk_pay_order=m, import_id="I", state=s) for m, k, s in rows
        ])
    )
    return control, RunTable(spark, str(tmp_path / "out"), RESULT, monthly.MONTH)


class Clock:
    def __init__(self):
        self.at = dt.datetime(2018, 6, 1)

    def __call__(self):
        self.at += dt.timedelta(minutes=1)
        return self.at


def work(rows):
    return rows.select("date_op", "ssylka_doc", monthly.month_number("date_op").alias(monthly.MONTH))


def states(control):
    found = control.read().groupBy(monthly.month_number("date_op").alias("m")).agg(F.collect_set("state").alias("s"))
    return {r.m: "".join(sorted(r.s)) for r in found.collect()}


def results(out):
    return sorted((r.pay_month, r.ssylka_doc) for r in out.read().collect())


ALL = [(m, k) for m in MONTHS for k in (1, 2)]


def test_months_are_claimed_run_and_completed_in_order(job):
    control, out = job
    assert monthly.import_months(control, out, work, Clock(), steps=1) == [201801]
    assert states(control) == {201801: "C", 201802: "N", 201803: "N", 201804: "N"}
    assert monthly.import_months(control, out, work, Clock(), at_once=2) == MONTHS[1:]
    assert results(out) == ALL
    assert monthly.import_months(control, out, work, Clock()) == []


@pytest.mark.parametrize("where", ["claim", "work", "results", "complete"])
def test_a_stopped_import_goes_on(job, monkeypatch, where):
    control, out = job
    monthly.import_months(control, out, work, Clock(), steps=1)
    writes = []

    def failing(rows):
        if where == "work":
            raise InterruptedError
        return work(rows)

    real = monthly.ControlTable.write, RunTable.replace

    def write(self, rows):
        writes.append(1)
        if (where, len(writes)) in (("claim", 1), ("complete", 2)):
            rows.write.mode("overwrite").parquet(self._version(self.latest() + 1))  # a snapshot without its mark of success
            hadoop = self.spark._jvm.org.apache.hadoop.fs
            mark = hadoop.Path(f"{self._version(self.latest())}/_SUCCESS")
            mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(mark, False)
            raise InterruptedError
        real[0](self, rows)

    def replace(self, rows):
        real[1](self, rows)
        if where == "results":
            raise InterruptedError

    with monkeypatch.context() as m:
        m.setattr(monthly.ControlTable, "write", write)
        m.setattr(RunTable, "replace", replace)
        with pytest.raises(InterruptedError):
            monthly.import_months(control, out, failing, Clock(), at_once=2)
    claimed = "N" if where == "claim" else "W"
    assert states(control) == {201801: "C", 201802: claimed, 201803: claimed, 201804: "N"}
    assert monthly.import_months(control, out, work, Clock()) == MONTHS[1:]
    assert results(out) == ALL


def test_reports_read_the_control_table(job):
    control, out = job
    monthly.import_months(control, out, work, Clock(), steps=2)
    table = control.read()
    assert {r.state: r.cnt for r in reports.progress_by_state(table).collect()} == {"C": 4, "N": 4}
    months = reports.progress_by_month(table).collect()
    assert [r.pay_month for r in months] == [D(2018, 1, 1), D(2018, 2, 1)]
    assert months[1].duration_min == 2
    assert reports.progress_listing(table).first().date_op == D(2018, 4, 10)
