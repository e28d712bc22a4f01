"""Registered queries: each plan over the mapped tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from pensio import schemas
from pensio.demo.mapping import Model
from pensio.functions.semantics import MONEY, add_months_keeping_end, text
from pensio.operators.constraints import (
    REJECT_TABLES,
    Check,
    ForeignKey,
    NotNull,
    append_with_rejects,
    check_constraints,
    reject_table_name,
)
from pensio.operators.rows import (
    apply_corrections,
    delete_by_key,
    delete_where,
    merge_insert_only,
    update_where,
    with_ids,
)
from pensio.plans import agreements, contracts, monthly, reconcile, registry, repair, reports, restrictions, run
from pensio.session import scratch_dir
from pensio.sources.runs import RunTable
from pensio.sources.snapshots import publish, stage
from pensio.sources.tables import ensure_reject_tables, read_table
from pensio.streaming.append import append_stream

# The operation date of the prepared run: that of payments accrued in August 1998.
DATE_OP = dt.date(1998, 9, 10)
# That of the run before it.
EARLIER_OP = dt.date(1998, 8, 10)


# Inline constants beside the fixed exclusions, for participants that every data folder holds.
LISTED_VERSIONS = ((1, "1998-01-01"), (2, "1999-03-10"), (3, "2000-07-21"), (5, "1997-11-30"), (8, "2001-02-14"))


class Plans(Model):
    """The public plans over the mapped tables."""

    @cached_property
    def v_contracts(self) -> DataFrame:
        return contracts.pension_contracts(
            self.sp_pen_dog, self.sp_lspv, self.sp_pen_dog_arh, self.contract_exclusions
        )

    @cached_property
    def v_periods(self) -> DataFrame:
        return contracts.contract_periods(self.v_contracts)

    @cached_property
    def v_payments(self) -> DataFrame:
        return contracts.payments_by_contract(self.vypl_pen, self.v_periods, self.line.select("d"))

    @cached_property
    def v_invalid(self) -> DataFrame:
        return restrictions.sp_invalid(self.sp_invalid, self.sp_invalid_arh)

    @cached_property
    def v_restrictions(self) -> DataFrame:
        return restrictions.sp_ogr_pv(self.sp_ogr_pv, self.sp_ogr_pv_arh, self.sp_lspv, self.v_invalid)

    @cached_property
    def v_restrictions_rev(self) -> DataFrame:
        return restrictions.sp_ogr_pv_rev(self.v_restrictions)

    @cached_property
    def v_restrictions_imp(self) -> DataFrame:
        starts = self.sp_ogr_pv.select("nach_deistv").unionByName(self.sp_ogr_pv_arh.select("nach_deistv"))
        return restrictions.restrictions_by_contract(
            self.v_restrictions_rev, self.v_periods, self.vypl_pen, starts
        )

    @cached_property
    def v_restrictions_fixed(self) -> DataFrame:
        starts = self.sp_ogr_pv.select("nach_deistv").unionByName(self.sp_ogr_pv_arh.select("nach_deistv"))
        return restrictions.restrictions_by_contract(
            self.v_restrictions_rev, self.v_periods, self.vypl_pen, starts, fixed=True
        )

    @cached_property
    def v_balances(self) -> DataFrame:
        return self.factored_balances.of()

    @cached_property
    def factored_balances(self) -> registry.FactoredBalances:
        return registry.factored_balances(self.sp_pen_dog, self.sp_ips, self.dv_sr_ips, self.kod_shifr_schet)

    @cached_property
    def v_changes(self) -> DataFrame:
        # One row of the mapped table is patched beside the fixed one.
        return registry.sp_izm_pd(
            self.sp_izm_pd, {**registry.CHANGE_DATE_PATCHES, 100: dt.date(2006, 11, 28)}
        )

    @cached_property
    def v_segments(self) -> DataFrame:
        return agreements.addendum_segments(self.pension_agreement_addendums)

    @cached_property
    def v_addendum_months(self) -> DataFrame:
        return agreements.addendum_months(self.v_segments)

    @cached_property
    def v_agreements(self) -> DataFrame:
        return agreements.pension_agreements(self.pension_agreements, self.contracts)

    @cached_property
    def updated_agreements(self) -> DataFrame:
        """The agreements with the states the run preparation gives them."""
        return run.update_states(self.pension_agreements, self.v_agreements, self.participants)

    @cached_property
    def v_updated_agreements(self) -> DataFrame:
        return agreements.pension_agreements(self.updated_agreements, self.contracts)

    @cached_property
    def v_active(self) -> DataFrame:
        return agreements.agreements_active(self.v_agreements)

    @cached_property
    def v_agreement_periods(self) -> DataFrame:
        return agreements.agreement_periods(self.pension_agreement_periods, self.v_active)

    @cached_property
    def participants(self) -> DataFrame:
        # A table at the source too: every step of the preparation reads it.
        # Payments of the one date are matched, not those of all years.
        paid = contracts.payments_by_contract(self.vypl_pen.where(F.col("data_op") == F.lit(DATE_OP)), self.v_periods)
        return stage(run.run_participants(paid, self.transform_contragents, self.v_agreements, DATE_OP))

    @cached_property
    def recorded_participants(self) -> DataFrame:
        """Participants with a disability record: the set the dossiers are asked for."""
        return self.v_invalid.select("ssylka_fl")

    @cached_property
    def quarterly_agreements(self) -> DataFrame:
        """Agreements with a quarterly period: the set the agreement dossiers are asked for."""
        return self.pension_agreements.where("period_code = 3").select("fk_contract")

    @cached_property
    def new_order_documents(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        dates = self.pay_orders.select("operation_date")
        return run.ensure_pay_orders(self.pay_orders, dates, 8_100_000_000)

    def participant_dossier(self) -> dict[str, DataFrame]:
        return reports.participant_dossier(
            self.recorded_participants,
            contracts=self.v_contracts,
            vypl_pen=self.vypl_pen,
            balances=self.factored_balances,
            changes=self.v_changes,
            restrictions=self.v_restrictions,
            invalid=self.v_invalid,
        )

    def agreement_dossier(self) -> dict[str, DataFrame]:
        return reports.agreement_dossier(
            self.quarterly_agreements,
            agreement_periods=self.v_agreement_periods,
            pension_agreements=self.pension_agreements,
            contracts=self.contracts,
            periods=self.pension_agreement_periods,
            pay_restrictions=self.pay_restrictions,
            addendums=self.pension_agreement_addendums,
            balances=self.accounts_balance,
            agreements_v=self.v_agreements,
            addendum_months=self.v_addendum_months,
        )


def _violations(p: Plans) -> DataFrame:
    """Declared rules of several tables, with the table and the row's key as text."""
    def of(table: str, df: DataFrame, rules, key: str) -> DataFrame:
        return check_constraints(df, rules, [key]).select(
            F.lit(table).alias("tbl"), "rule", F.col(key).cast("string").alias("row_key")
        )

    filters = schemas.rules("pay_order_filters", {"pay_orders": p.pay_orders})
    periods = schemas.rules("pension_agreement_periods", {"pension_agreements": p.pension_agreements})
    balances = schemas.rules("accounts_balance", {"accounts": p.accounts})
    return (
        of("pay_order_filters", p.pay_order_filters, filters, "id")
        .unionByName(of("pension_agreement_periods", p.pension_agreement_periods, periods, "fk_pension_agreement"))
        .unionByName(of("accounts_balance", p.accounts_balance, balances, "fk_account"))
        .unionByName(
            of("pension_agreements", p.pension_agreements, schemas.rules("pension_agreements"), "fk_contract")
        )
        .unionByName(
            of(
                "debt_withholdings",
                p.debt_withholdings,
                schemas.rules("debt_withholdings", {"assignments": p.assignments}),
                "fk_debt_assignment",
            )
        )
        .unionByName(
            of("control_batch", p.control_batch, schemas.rules("transform_pa_assignments"), "line_id")
        )
    )


def _appended(p: Plans) -> DataFrame:
    """Accruals appended to nothing, in the order of their given ids; both outcomes side by side."""
    rules = [
        NotNull("fk_doc_with_acct"),
        Check("paydays under 50", "paydays < 50"),
        ForeignKey(("fk_doc_with_acct",), p.v_agreements, ("fk_contract",)),
    ]
    accepted, rejected = append_with_rejects(
        p.assignments.withColumnRenamed("id", "given"),
        rules,
        ["given"],
        defaults=schemas.defaults("assignments", dt.datetime(1998, 9, 1, 12)),
        ids="id",
        first_id=1001,
        tag="accrual",
    )
    kept = ["id", "given", "amount", "paytax", "iscancel", "direction", "creation_date"]
    return accepted.select(
        F.lit("accepted").alias("outcome"),
        F.lit(None).cast("int").alias("error_number"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("string").alias("error_tag"),
        *[F.col(c).cast("string") for c in kept],
    ).unionByName(
        rejected.select(
            F.lit("rejected").alias("outcome"), "error_number", "error_message", "error_tag", *kept
        )
    )


def _appended_unique(p: Plans) -> DataFrame:
    """Control rows under their unique rule: the first complete row of each key is taken."""
    accepted, rejected = append_with_rejects(
        p.control_batch,
        schemas.rules("transform_pa_assignments"),
        ["line_id"],
        target=p.transform_pa_assignments.where("state = 'W'"),
    )
    return _outcomes(accepted, rejected)


def _outcomes(accepted: DataFrame, rejected: DataFrame, *more: str) -> DataFrame:
    kept = ["line_id", *more]
    return accepted.select(
        F.lit("accepted").alias("outcome"), F.lit(None).cast("int").alias("error_number"),
        *[F.col(c).cast("string").alias(c) for c in kept],
    ).unionByName(
        rejected.select(F.lit("rejected").alias("outcome"), "error_number", *kept)
    )


def _appended_stream(p: Plans) -> DataFrame:
    """The control rows delivered in three parts by line number, as a stream of one part a micro-batch, with ids.

    The stream is started once a part on the same checkpoint, so a micro-batch is all files of its part.
    """
    root = scratch_dir(p.spark)
    for part in range(3):
        p.lineitem.where(F.col("l_linenumber") % 3 == part).write.mode("append").parquet(f"{root}/arriving")
        arriving = p.with_table("lineitem", p.spark.readStream.schema(p.lineitem.schema).parquet(f"{root}/arriving"))
        sink = append_stream(
            arriving.control_batch.withColumn("given", F.lit(None).cast("long")),
            f"{root}/accepted",
            f"{root}/rejected",
            f"{root}/checkpoint",
            schemas.rules("transform_pa_assignments"),
            ["line_id"],
            ids="given",
            first_id=100,
        )
        sink.trigger(availableNow=True).start().awaitTermination()
    return _outcomes(p.spark.read.parquet(f"{root}/accepted"), p.spark.read.parquet(f"{root}/rejected"), "given")


def _appended_two_keys(p: Plans) -> DataFrame:
    """Documents under both unique rules of their table: first come, first served."""
    accepted, rejected = append_with_rejects(p.document_batch, schemas.rules("transform_po"), ["line_id"])
    return _outcomes(accepted, rejected)


def _scanned(p: Plans, table: str) -> DataFrame:
    """A table written in the model's layout, twice over the same place, and read with its declared schema."""
    root = scratch_dir(p.spark)
    for _ in range(2):
        publish(getattr(p, table), f"{root}/{table}")
    return read_table(p.spark, root, table)


def _order_inserts(p: Plans) -> DataFrame:
    """Both targets of the two-way insert, told apart by a label."""
    _, documents, orders = p.new_order_documents
    return documents.select(
        F.lit("documents").alias("target"), F.col("id"), F.col("doc_date"), "title",
        F.lit(None).cast("date").alias("payment_period"),
    ).unionByName(
        orders.select(
            F.lit("pay_orders").alias("target"), F.col("fk_document").alias("id"),
            F.col("operation_date").alias("doc_date"), F.col("payment_freqmask").alias("title"),
            "payment_period",
        )
    )


def _captured(p: Plans) -> DataFrame:
    """Both results of a run's capture, told apart by a label."""
    order = run.run_order(p.pay_orders, DATE_OP)
    filters, result = run.capture_run(p.assignments, p.order_filters, order)
    return filters.select(F.lit("filter").alias("part"), "id", "fk_pay_order").unionByName(
        result.select(F.lit("assignment").alias("part"), "id", F.col("fk_doc_with_action").alias("fk_pay_order"))
    )


def _purged(p: Plans) -> DataFrame:
    """What a purge removed from each table and what it left, with the layout of what is left."""
    tables = {"debt_withholdings": p.debt_withholdings, "assignments": p.assignments, "pay_orders": p.pay_orders}
    root = scratch_dir(p.spark)
    gone = run.purge(tables, root)
    layouts = [(name, ",".join(p.spark.read.parquet(f"{root}/{name}").columns)) for name in tables]
    values = ", ".join(f"('{name}', '{columns}')" for name, columns in layouts)
    return gone.join(p.spark.sql(f"SELECT * FROM VALUES {values} AS t(tbl, columns_left)"), "tbl").select(
        "step", "tbl", "rows_removed", "rows_left", "columns_left"
    )


def _runs(p: Plans) -> DataFrame:
    """Accruals kept by run: one run replaced by that of the second calculation, the one before it deleted."""
    assignments = p.assignments
    held = RunTable(p.spark, scratch_dir(p.spark), assignments.schema)
    held.replace(assignments)
    held.replace(run.snapshot_run(p.assignments_new, p.pay_orders, DATE_OP))
    run.delete_run_folder(held, p.pay_orders, EARLIER_OP)
    return held.read()


def _imported(p: Plans) -> DataFrame:
    """An import of all months that is stopped once while it has claimed months: their state and what they paid."""
    root = scratch_dir(p.spark)
    control = monthly.ControlTable(p.spark, f"{root}/control")
    control.write(p.transform_pa_assignments.withColumn("state", F.lit(monthly.NEW)))
    kinds = T.StructType.fromDDL("date_op date, ssylka_doc long, payments long, paid decimal(18,2), pay_month int")
    results = RunTable(p.spark, f"{root}/paid", kinds, monthly.MONTH)

    def work(rows: DataFrame) -> DataFrame:
        keys = rows.select("date_op", "ssylka_doc")
        paid = p.vypl_pen.select(F.col("data_op").alias("date_op"), "ssylka_doc", "summa")
        return (
            keys.join(paid, ["date_op", "ssylka_doc"])
            .groupBy("date_op", "ssylka_doc")
            .agg(F.count(F.lit(1)).alias("payments"), F.sum("summa").alias("paid"))
            .withColumn(monthly.MONTH, monthly.month_number("date_op"))
        )

    def stopped(rows: DataFrame) -> DataFrame:
        raise InterruptedError

    def now() -> dt.datetime:
        return dt.datetime(1998, 9, 1, 12)

    try:
        monthly.import_months(control, results, stopped, now, at_once=5)
    except InterruptedError:
        pass
    monthly.import_months(control, results, work, now, at_once=40)
    states = control.read().groupBy(monthly.month_number("date_op").alias("month"), "state", "last_update_date").agg(
        F.count(F.lit(1)).alias("control_rows")
    )
    totals = results.read().groupBy(F.col(monthly.MONTH).alias("month")).agg(
        F.sum("payments").alias("payments"), F.sum("paid").alias("paid")
    )
    return states.join(totals, "month", "left")


def _reject_tables(p: Plans) -> DataFrame:
    """The import's reject tables with their number of columns, and rejected rows by error number."""
    root = scratch_dir(p.spark)
    documents = T.StructType([p.assignments.schema["id"]])
    ensure_reject_tables(p.spark, root, {"documents": documents})
    batches = {
        "ACCOUNTS_BALANCE": (p.accounts_balance, schemas.rules("accounts_balance", {"accounts": p.accounts}), "fk_account"),
        "PENSION_AGREEMENTS": (p.pension_agreements, schemas.rules("pension_agreements"), "fk_contract"),
        "PAY_RESTRICTIONS": (p.pay_restrictions, [NotNull("expiration_date")], "id"),
    }
    names = dict(REJECT_TABLES)
    for table, (batch, rules, key) in batches.items():
        _, rejected = append_with_rejects(batch, rules, [key], tag="import")
        rejected.write.mode("append").parquet(f"{root}/{reject_table_name(table, names[table])}")

    def described(table: str, name: str | None) -> DataFrame:
        name = reject_table_name(table, name)
        held = p.spark.read.parquet(f"{root}/{name}")
        return held.groupBy("error_number", "error_tag").agg(F.count(F.lit(1)).alias("cnt")).unionByName(
            p.spark.sql("SELECT CAST(NULL AS INT) AS error_number, CAST(NULL AS STRING) AS error_tag, 0L AS cnt")
        ).select(F.lit(name).alias("tbl"), F.lit(len(held.columns)).alias("n_columns"), "error_number", "error_tag", "cnt")

    return reduce(DataFrame.unionByName, [described(*t) for t in REJECT_TABLES])


def _update_where(p: Plans) -> DataFrame:
    return update_where(
        p.contracts,
        {"fk_company": F.lit(0)},
        keys=p.v_active.select(F.col("fk_contract").alias("fk_document")),
        on=["fk_document"],
        where=F.col("fk_cntr_type") == agreements.AGREEMENT_CONTRACT_TYPE,
    )


QUERIES: dict[str, Callable[[Plans], DataFrame]] = {
    # sources and sinks
    "scan_table": lambda p: _scanned(p, "pension_agreements"),
    "snapshot_run": lambda p: run.snapshot_run(p.assignments, p.pay_orders, DATE_OP),
    "append_with_rejects": _appended,
    "append_unique": _appended_unique,
    "append_stream": _appended_stream,
    "append_two_keys": _appended_two_keys,
    "check_constraints": _violations,
    "multi_insert": _order_inserts,
    "merge_insert_only": lambda p: merge_insert_only(
        p.pay_order_filters,
        p.filter_requests,
        ["fk_pay_order", "filter_code", "filter_value"],
        ids="id",
        first_id=20_000_000_000,
    ),
    "update_where": _update_where,
    "delete_by_key": lambda p: delete_by_key(p.assignments, p.quarterly_agreements.toDF("fk_doc_with_acct"), ["fk_doc_with_acct"]),
    "delete_run": lambda p: run.delete_run(p.assignments, p.pay_orders, DATE_OP),
    "delete_where": lambda p: delete_where(p.assignments, F.col("direction") == -1),
    "surrogate_key": lambda p: with_ids(p.filter_requests, "id", ["fk_pay_order"], 500),
    "ensure_pay_orders": lambda p: p.new_order_documents[0],
    "const_relation": lambda p: contracts.not_in_pairs(
        p.sp_pen_dog_arh,
        contracts.exclusions(p.spark, (*contracts.CONTRACT_EXCLUSIONS, *LISTED_VERSIONS)),
        ("ssylka", "data_arh"),
        ("ssylka_fl", "data_arh"),
    ),
    # views
    "contract_labels": lambda p: p.sp_pen_dog.select(
        "ref_kodinsz",
        text(F.upper(F.trim("fio")), F.lit("/"), F.substring("nom_dog", 2, 4), F.date_format("data_nach_vypl", "yyyyMMdd"))
        .alias("label"),
    ),
    "accounts_sspv": lambda p: agreements.accounts_sspv(p.accounts),
    "izmeneniya_pd": lambda p: registry.izmeneniya_pd(p.izmeneniya, p.izm_key_val, p.izm_spr_soderg),
    "registry_pay_orders": lambda p: registry.registry_pay_orders(p.reer_doc_ngpf),
    "sp_invalid": lambda p: p.v_invalid,
    "ips_balances": lambda p: p.v_balances,
    "sp_izm_pd": lambda p: p.v_changes,
    "sp_ogr_pv": lambda p: p.v_restrictions,
    "sp_ogr_pv_rev": lambda p: p.v_restrictions_rev,
    "pension_contracts": lambda p: p.v_contracts,
    "contract_periods": lambda p: p.v_periods,
    "payments_by_contract": lambda p: p.v_payments,
    "payments_by_contract_asof": lambda p: contracts.payments_by_contract(p.vypl_pen, p.v_periods, asof=True),
    "paid_by_contract": lambda p: contracts.paid_by_contract(p.v_payments),
    "restrictions_by_contract": lambda p: p.v_restrictions_imp,
    "restrictions_fixed": lambda p: p.v_restrictions_fixed,
    "addendum_segments": lambda p: p.v_segments,
    "addendum_months": lambda p: p.v_addendum_months,
    "pay_order_periods": lambda p: agreements.pay_order_periods(p.pay_orders),
    "pension_agreements": lambda p: p.v_agreements,
    "agreements_active": lambda p: p.v_active,
    "agreements_import": lambda p: agreements.agreements_import(p.v_agreements),
    "agreement_periods": lambda p: p.v_agreement_periods,
    # run preparation
    "run_participants": lambda p: p.participants,
    "deactivate_agreements": lambda p: run.deactivate_agreements(
        p.pension_agreements, p.v_agreements, p.participants
    ),
    "activate_agreements": lambda p: run.activate_agreements(
        p.pension_agreements, p.v_agreements, p.participants
    ),
    "cancel_restrictions": lambda p: run.cancel_restrictions(p.pay_restrictions, p.participants),
    "reopen_addenda": lambda p: run.reopen_addenda(
        p.pension_agreement_addendums, p.participants, DATE_OP
    ),
    "cancel_recent_addenda": lambda p: run.cancel_recent_addenda(
        run.reopen_addenda(p.pension_agreement_addendums, p.participants, DATE_OP), p.participants, DATE_OP
    ),
    "agreements_without_addenda": lambda p: run.agreements_without_addenda(
        p.participants, p.v_updated_agreements, p.pension_agreement_addendums
    ),
    "capture_run": _captured,
    "purge_runs": _purged,
    "run_folders": _runs,
    "reject_tables": _reject_tables,
    "monthly_import": _imported,
    # reconciliation and reports
    "reconcile_assignments": lambda p: reconcile.reconcile_assignments(
        p.assignments, p.assignments_new, p.v_agreement_periods, p.accounts_balance
    ),
    "reconcile_two_way": lambda p: reconcile.reconcile_two_way(p.assignments, p.assignments_new),
    "run_size_compare": lambda p: reconcile.run_size_compare(
        {"reference": p.assignments.where("fk_asgmt_type = 2"), "new": p.assignments_new}
    ),
    "ips_balance_sizes": lambda p: p.factored_balances.sizes(),
    "payment_due_dates": lambda p: p.vypl_pen.select(
        "ssylka_fl", "data_nachisl", "data_op", add_months_keeping_end("data_nachisl", 1).alias("next_month"),
        add_months_keeping_end("data_nachisl", F.col("tip_vypl") * -1).alias("earlier_month"),
    ).distinct(),
    "participant_agreement": lambda p: reports.participant_agreement(p.v_agreements, p.transform_contragents),
    "participant_balance": lambda p: registry.participant_balance(
        p.sp_pen_dog, p.sp_ips, p.dv_sr_ips, p.kod_shifr_schet
    ),
    **{
        f"participant_dossier_{part}": lambda p, part=part: p.participant_dossier()[part]
        for part in ("contracts", "payments", "balances", "changes", "restrictions", "invalid")
    },
    **{
        f"agreement_dossier_{part}": lambda p, part=part: p.agreement_dossier()[part]
        for part in (
            "calculation", "agreement", "contract", "periods", "restrictions", "addenda", "balance",
            "addendum_months",
        )
    },
    "progress_by_state": lambda p: reports.progress_by_state(p.transform_pa_assignments),
    "progress_by_month": lambda p: reports.progress_by_month(p.transform_pa_assignments),
    "progress_listing": lambda p: reports.progress_listing(p.transform_pa_assignments),
    "pay_order_summary": lambda p: reports.pay_order_summary(
        p.transform_pa_assignments, p.transform_po, p.assignments
    ),
    "run_span_summary": lambda p: reports.run_span_summary(p.assignments, p.pay_orders),
    # repairs
    "apply_corrections": lambda p: apply_corrections(
        p.reer_doc_ngpf, p.corrections, "ssylka", ["kod_insz", "ref_kodinsz"]
    ),
    "correct_contragents": lambda p: apply_corrections(
        p.transform_contragents, p.contragent_corrections, "fk_contract", ["ssylka_fl"]
    ),
    "backfill_contract_ref": lambda p: repair.backfill_contract_ref(
        p.sp_pen_dog_unlinked, p.pension_agreements, p.contracts, p.transform_contragents
    ),
    "backfill_contract_ref_strict": lambda p: repair.backfill_contract_ref(
        p.sp_pen_dog_unlinked, p.pension_agreements, p.contracts, p.transform_contragents, strict=True
    ),
    "contracts_without_agreement": lambda p: repair.contracts_without_agreement(
        p.sp_pen_dog_unlinked, p.pension_agreements
    ),
}


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text (open ends lie outside what other clients can hold), money at one scale."""
    def column(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast(MONEY)
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, plan=plan: comparable(plan(Plans(spark, sf_dir))))
        for name, plan in QUERIES.items()
    }
