"""Legacy registry documents, change log, account movements and change rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pensio.functions import registry_text as rt
from pensio.functions.semantics import MONEY, month_start
from pensio.operators.ordering import windowed
from pensio.operators.rows import apply_corrections
from pensio.plans.contracts import SKIPPED_CONTRIBUTOR

# Plan types whose contracts hold an individual account.
ACCOUNT_SCHEMES = (2, 3, 4, 5, 8)
# Corrected dates of change rows (row id -> date).
CHANGE_DATE_PATCHES = {2060058: dt.date(2006, 11, 28)}


def izmeneniya_pd(izmeneniya: DataFrame, izm_key_val: DataFrame, izm_spr_soderg: DataFrame) -> DataFrame:
    """Change log with the participant it concerns and the description of its change code."""
    concerned = izm_key_val.where((F.col("nom_trans") == 1) & (F.col("fld_nom") == 1)).select(
        F.col("val").alias("ssylka_fl_str"), "nom_izm"
    )
    # Every change matches a handful of codes: the description is joined last, on the already reduced rows.
    return (
        izmeneniya.join(concerned, "nom_izm")
        .join(izm_spr_soderg.select("kod_izm", "soderg"), "kod_izm")
        .select(
            "ssylka_fl_str", "nom_izm", "kod_izm", "kod_doc", "kod_oper", "data_otrab", "data_zanes", "kod_sost",
            "soderg",
        )
    )


def registry_pay_orders(reer_doc_ngpf: DataFrame) -> DataFrame:
    """Pay orders read out of registry documents, numbered inside their half-month; plus the exception ones.

    A day that does not exist in its month fails the query, as it does at the source.
    """
    content, document = F.col("kr_soderg"), F.col("ssylka")
    read = (
        reer_doc_ngpf.where(rt.is_payment_closing(content) & ~document.isin(*rt.NOT_PAY_ORDERS))
        .withColumn("_day", rt.operation_day(content, F.col("data_doc")))
        .withColumn("_month", rt.operation_month(content, document, F.col("data_doc")))
        .withColumn("_year", rt.operation_year(content, document))
        .withColumn("operation_date", F.make_date("_year", "_month", "_day"))
        .withColumn("payment_period", F.make_date("_year", "_month", F.lit(1)))
        .withColumn("half_month", rt.half_month(F.col("_day"), document))
    )
    # At most one row per calendar month.
    last_half = read.groupBy(F.col("payment_period").alias("_period")).agg(F.max("half_month").alias("max_half_month"))
    numbered = windowed(
        read.join(last_half, F.col("payment_period").eqNullSafe(F.col("_period"))),
        ["payment_period", "half_month"],
        ["_day", "ssylka"],
        bucket=[F.col("_day"), F.floor(F.col("ssylka") / 100_000)],
        rn="rn",
    )
    rest = ["tip_doc", "data_doc", "kem_podpis", "kr_soderg"]
    regular = numbered.select(
        F.lit(1).alias("flag_usage"), "rn", "max_half_month", document.alias("ssylka_doc"),
        F.col("ref_kodinsz").alias("fk_document"), "operation_date", "payment_period", "half_month", *rest,
    )
    exceptions = reer_doc_ngpf.where(document.isin(*rt.EXCEPTION_PAY_ORDERS)).select(
        F.lit(2).alias("flag_usage"), F.lit(1).alias("rn"), F.lit(1).alias("max_half_month"),
        document.alias("ssylka_doc"), F.col("ref_kodinsz").alias("fk_document"),
        F.col("data_doc").alias("operation_date"), month_start("data_doc").alias("payment_period"),
        F.lit(1).alias("half_month"), *rest,
    )
    return regular.unionByName(exceptions)


def _account_contracts(sp_pen_dog: DataFrame) -> DataFrame:
    return sp_pen_dog.where(
        F.col("shema_dog").isin(*ACCOUNT_SCHEMES) & (F.col("nom_vkl") != SKIPPED_CONTRIBUTOR)
    )


def _movements(sp_ips: DataFrame, dv_sr_ips: DataFrame, kod_shifr_schet: DataFrame) -> DataFrame:
    """Signed account movements with the participant that owns the account."""
    account = sp_ips.select("ssylka_fl", "nom_vkl", "nom_ips", "tip_lits")
    sign = kod_shifr_schet.select("shifr_schet", "sub_shifr_schet", "ips")
    return (
        dv_sr_ips.join(sign, ["shifr_schet", "sub_shifr_schet"])
        .join(account, ["nom_vkl", "nom_ips"])
        .withColumn("amount", (F.col("ips") * F.col("summa")).cast(MONEY))
    )


def ips_balances(
    sp_pen_dog: DataFrame, sp_ips: DataFrame, dv_sr_ips: DataFrame, kod_shifr_schet: DataFrame
) -> DataFrame:
    """Signed movements of each participant's accounts beside each of the participant's contracts.

    Every movement appears under every contract of its participant: that is the result asked for. Use
    ``participant_balance`` for sums and ``factored_balances`` for numbers and sets of participants: they do not build it.
    """
    return factored_balances(sp_pen_dog, sp_ips, dv_sr_ips, kod_shifr_schet).of()


@dataclass(frozen=True)
class FactoredBalances:
    """``ips_balances`` as what it is made of: ``movements`` and ``contracts``, which meet on the participant.

    The rows of the product are counted without building it, and built for a set of participants only.
    """

    movements: DataFrame
    contracts: DataFrame

    def sizes(self) -> DataFrame:
        """(ssylka, movements, contracts, balances) of each participant who has both."""
        a = self.movements.groupBy("ssylka").agg(F.count(F.lit(1)).alias("movements"))
        b = self.contracts.groupBy("ssylka").agg(F.count(F.lit(1)).alias("contracts"))
        return a.join(b, "ssylka").withColumn("balances", F.col("movements") * F.col("contracts"))

    def of(self, participants: DataFrame | None = None) -> DataFrame:
        """The rows of ``ips_balances``, of the participants in the first column of ``participants`` if given."""
        left, right = self.movements, self.contracts
        if participants is not None:
            ids = participants.select(F.col(participants.columns[0]).alias("ssylka")).distinct()
            left, right = (df.join(ids, "ssylka", "left_semi") for df in (left, right))
        return left.join(right, "ssylka").select(
            "ref_kodinsz", "ssylka", "data_nach_vypl", "date_op", "amount", "data_perevoda_5_cx", "shifr_schet",
            "sub_shifr_schet", "nom_vkl", "nom_ips", "tip_lits", "ips_nom_vkl", "ips_nom_ips",
        )


def factored_balances(
    sp_pen_dog: DataFrame, sp_ips: DataFrame, dv_sr_ips: DataFrame, kod_shifr_schet: DataFrame
) -> FactoredBalances:
    """Signed movements of each participant's accounts, and each participant's contracts."""
    movement = _movements(sp_ips, dv_sr_ips, kod_shifr_schet).select(
        F.col("ssylka_fl").alias("ssylka"), F.col("data_op").alias("date_op"), "amount", "shifr_schet",
        "sub_shifr_schet", "tip_lits", F.col("nom_vkl").alias("ips_nom_vkl"),
        F.col("nom_ips").alias("ips_nom_ips"),
    )
    contract = _account_contracts(sp_pen_dog).select(
        "ref_kodinsz", "ssylka", "data_nach_vypl", "data_perevoda_5_cx", "nom_vkl", "nom_ips"
    )
    return FactoredBalances(movement, contract)


def participant_balance(
    sp_pen_dog: DataFrame, sp_ips: DataFrame, dv_sr_ips: DataFrame, kod_shifr_schet: DataFrame
) -> DataFrame:
    """Sum of ``ips_balances`` by participant, contract start and transfer date.

    Both sides are reduced per participant before they meet: a sum over all pairs is the number of contracts
    times the sum of movements.
    """
    total = (
        _movements(sp_ips, dv_sr_ips, kod_shifr_schet)
        .groupBy(F.col("ssylka_fl").alias("ssylka"))
        .agg(F.sum("amount").alias("_total"))
    )
    contracts = (
        _account_contracts(sp_pen_dog)
        .groupBy("ssylka", "data_nach_vypl", F.col("data_perevoda_5_cx").alias("transfer_date"))
        .agg(F.count(F.lit(1)).alias("_contracts"))
    )
    return contracts.join(total, "ssylka").select(
        "ssylka",
        "data_nach_vypl",
        "transfer_date",
        (F.col("_contracts") * F.col("_total")).cast(MONEY).alias("amount"),
    )


def sp_izm_pd(changes: DataFrame, patches: dict[int, dt.date] = CHANGE_DATE_PATCHES) -> DataFrame:
    """Change rows with corrected dates."""
    values = ", ".join(f"({int(i)}L, DATE '{d.isoformat()}')" for i, d in patches.items())
    corrections = changes.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(id, data_izm)")
    return apply_corrections(changes, corrections, "id", ["data_izm"]).select(
        "ssylka_fl", "nom_izm", "data_izm", "summa_izm", "otpechatano", "ssylka_doc", "mod_pism",
        "data_pism", "sagenev", "dat_zanes", "no_otpr", "coment", "id", "sostoyanie", "forma",
    )
