"""Legacy contracts, their validity intervals, and payments by contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from pensio.functions.semantics import OPEN_END, OPEN_START, day, month_start
from pensio.operators.intervals import asof_join, interval_join
from pensio.operators.ordering import windowed

# Archived contract versions to leave out, as (participant, archive time).
CONTRACT_EXCLUSIONS = (
    (1508, "2004-05-09 17:33:44"),
    (1610, "2004-05-09 17:33:44"),
    (4097, "2006-07-18 17:15:06"),
    (21957, "2004-05-09 17:33:44"),
    (28757, "2004-05-09 17:33:44"),
    (30107, "2004-05-09 17:33:44"),
    (33849, "2004-05-09 17:33:44"),
    (35870, "2004-05-09 17:33:44"),
    (90172, "2016-04-26 13:53:28"),
    (98605, "2014-01-20 11:03:31"),
    (98658, "2010-12-27 14:21:33"),
    (102043, "2011-01-28 10:58:53"),
    (142653, "2016-04-14 13:13:49"),
    (152134, "2016-02-26 10:48:51"),
    (187692, "2016-04-26 13:54:50"),
    (238814, "2016-06-23 17:02:34"),
    (311206, "2011-05-03 16:00:28"),
    (1033359, "2016-05-13 12:29:57"),
    (1658415, "2016-05-17 14:08:18"),
)
# Contributor whose contracts are never migrated.
SKIPPED_CONTRIBUTOR = 1001
CURRENT, ARCHIVE = "SP_PEN_DOG", "SP_PEN_DOG_ARH"

# Columns both contract tables share and the result carries unchanged.
_CARRIED = (
    "nom_vkl", "nom_ips", "fio", "data_otkr", "ssylka", "data_nach_vypl", "razm_pen", "delta_pen",
    "delta_pere", "summa", "summa_u", "summa_c", "data_dog", "nom_dog", "flag", "kod_oper", "flg_admin",
    "data", "sopr_oper", "nom_pz", "type_dog", "data_uvoln", "shema_dog", "data_perevoda_5_cx",
    "id_period_payment", "id_letter", "ref_kodinsz", "kod_insz", "summa_perevoda_5_cx",
)


def exclusions(spark, pairs=CONTRACT_EXCLUSIONS) -> DataFrame:
    """The inline exclusion list as a relation (ssylka_fl, data_arh), whose size the planner sees."""
    rows = ", ".join(f"({int(k)}L, TIMESTAMP_NTZ '{dt.datetime.fromisoformat(t)}')" for k, t in pairs)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(ssylka_fl, data_arh)")


def not_in_pairs(df: DataFrame, pairs: DataFrame, left: tuple[str, str], right: tuple[str, str]) -> DataFrame:
    """Rows of ``df`` whose column pair is NOT IN ``pairs``, with the three-valued logic of a tuple NOT IN.

    A row is also dropped when its comparison is unknown: one side NULL and the other listed, or both NULL
    and the list not empty. ``pairs`` itself holds no NULLs. Spelling these cases out as listed pairs with
    NULLs turns the whole test into one null-safe anti-join that hashes on both columns.
    """
    (a, b), (x, y) = left, right
    no_x, no_y = (F.lit(None).cast(pairs.schema[c].dataType) for c in (x, y))
    cases = [(F.col(x), F.col(y)), (F.col(x), no_y), (no_x, F.col(y)), (no_x, no_y)]
    listed = (
        pairs.select(F.explode(F.array(*[F.struct(p.alias("x"), q.alias("y")) for p, q in cases])).alias("p"))
        .select(F.col("p.x").alias("_x"), F.col("p.y").alias("_y"))
        .distinct()
    )
    same = df[a].eqNullSafe(listed["_x"]) & df[b].eqNullSafe(listed["_y"])
    return df.join(listed, same, "left_anti")


def pension_contracts(
    sp_pen_dog: DataFrame, sp_lspv: DataFrame, sp_pen_dog_arh: DataFrame, excluded: DataFrame | None = None
) -> DataFrame:
    """Current and archived contracts of each participant, numbered by start date.

    ``data_okon_vypl`` is the day before the participant's next contract starts. Equal starts are ordered by
    ``ref_kodinsz``, source, archive time, account status and start, and contract number, which the source system leaves
    open: a participant with several accounts has each contract once per account.
    """
    if excluded is None:
        excluded = exclusions(sp_pen_dog.sparkSession)
    account = sp_lspv.select(
        F.col("ssylka_fl").alias("_fl"), "status_pen", F.col("nach_vypl_pen").alias("_nach")
    )
    current = (
        sp_pen_dog.where(F.col("nom_vkl") != SKIPPED_CONTRIBUTOR)
        .join(account, F.col("ssylka") == F.col("_fl"), "left")
        .select(
            F.lit(CURRENT).alias("source_table"),
            *_CARRIED,
            "status_pen",
            F.lit(None).cast("timestamp_ntz").alias("data_arh"),
            F.coalesce("_nach", "data_nach_vypl").alias("lspv_nach_vypl_pen"),
            F.col("data_okon_vypl").alias("pd_data_okon_vypl"),
            F.col("data").cast("timestamp_ntz").alias("cntr_print_date"),
            F.coalesce(F.col("data").cast("date"), F.col("data_nach_vypl")).alias("cntr_date"),
        )
    )
    kept = not_in_pairs(
        sp_pen_dog_arh.where(F.col("nom_vkl") != SKIPPED_CONTRIBUTOR),
        excluded,
        ("ssylka", "data_arh"),
        ("ssylka_fl", "data_arh"),
    )
    archived = kept.select(
        F.lit(ARCHIVE).alias("source_table"),
        *_CARRIED,
        F.lit("A").alias("status_pen"),
        F.col("data_arh").cast("timestamp_ntz").alias("data_arh"),
        F.col("data_nach_vypl").alias("lspv_nach_vypl_pen"),
        F.col("data_okon_vypl").alias("pd_data_okon_vypl"),
        F.col("data_arh").cast("timestamp_ntz").alias("cntr_print_date"),
        F.coalesce(F.col("data_arh").cast("date"), F.col("data_nach_vypl")).alias("cntr_date"),
    )
    numbered = windowed(
        current.unionByName(archived),
        ["ssylka"],
        ["data_nach_vypl", "ref_kodinsz", "source_table", "data_arh", "status_pen", "lspv_nach_vypl_pen", "nom_dog"],
        bucket=[F.year("data_nach_vypl")],
        rn="dog_rn",
        cnt="dog_cnt",
        lead={"_next": "data_nach_vypl"},
    )
    return numbered.select(
        "dog_rn", "dog_cnt", "source_table", "nom_vkl", "nom_ips", "fio", "data_arh", "data_otkr", "ssylka",
        "status_pen", "data_nach_vypl", F.date_sub("_next", 1).alias("data_okon_vypl"), "lspv_nach_vypl_pen",
        "pd_data_okon_vypl", "razm_pen", "delta_pen", "delta_pere", "summa", "summa_u", "summa_c", "data_dog",
        "nom_dog", "flag", "kod_oper", "flg_admin", "data", "sopr_oper", "nom_pz", "type_dog", "data_uvoln",
        "shema_dog", "data_perevoda_5_cx", "id_period_payment", "id_letter", "ref_kodinsz", "kod_insz",
        "summa_perevoda_5_cx", "cntr_print_date", "cntr_date",
    )


def contract_periods(contracts: DataFrame) -> DataFrame:
    """Month-aligned validity interval of each contract.

    The first contract is open to the past, the last to the future. Any other one ends a month before the month
    of its last day, which leaves a month without contract when the next one starts on the first (kept as is).
    The intervals of one participant never overlap.
    """
    return contracts.select(
        "dog_rn", "dog_cnt", "ssylka", "source_table", "nom_vkl", "nom_ips", "fio", "status_pen",
        F.when(F.col("dog_rn") == 1, day(OPEN_START))
        .otherwise(month_start("data_nach_vypl")).alias("from_date"),
        F.when(F.col("dog_rn") == F.col("dog_cnt"), day(OPEN_END))
        .otherwise(F.date_sub(month_start("data_okon_vypl"), 1)).alias("to_date"),
        "data_nach_vypl", "data_okon_vypl", "lspv_nach_vypl_pen", "pd_data_okon_vypl", "data_otkr", "type_dog",
        "shema_dog", "razm_pen", "data_perevoda_5_cx", "ref_kodinsz", "data_arh", "data",
    )


def payments_by_contract(
    vypl_pen: DataFrame, periods: DataFrame, accruals: DataFrame | None = None, *, asof: bool = False
) -> DataFrame:
    """Each payment with the contract whose interval contains its accrual date.

    ``accruals`` may name a cheaper DataFrame than ``vypl_pen`` whose first column covers the accrual dates. With
    ``asof`` the contract is looked up in one sorted list of payments and contract starts instead of a join by year: open
    intervals are not repeated, and a participant of any size is cut by month, for a sort of all payments.
    """
    contract = periods.select(
        F.col("ssylka").alias("ssylka_fl"), "status_pen", "data_nach_vypl", "data_okon_vypl",
        "lspv_nach_vypl_pen", "pd_data_okon_vypl", "ref_kodinsz", "shema_dog", "data_perevoda_5_cx",
        "source_table", "from_date", "to_date", "data",
    )
    payment = vypl_pen.select(
        "ssylka_fl", "data_op", "data_nachisl", "tip_vypl", "summa", "oplach_dni", "nom_vkl", "nom_ips",
        "ssylka_doc",
    )
    at = dict(key="ssylka_fl", point="data_nachisl", lo="from_date", hi="to_date")
    if asof:
        matched = asof_join(payment, contract, **at)
    else:
        matched = interval_join(payment, contract, **at, years=accruals)
    return matched.select(
        "status_pen", "ssylka_fl", "data_op", "data_nachisl", "tip_vypl", "summa", "oplach_dni",
        "data_nach_vypl", "data_okon_vypl", "lspv_nach_vypl_pen", "pd_data_okon_vypl", "ref_kodinsz",
        "shema_dog", "data_perevoda_5_cx", "nom_vkl", "nom_ips", "source_table", "from_date", "to_date", "data",
        "ssylka_doc",
    )


def paid_by_contract(payments: DataFrame) -> DataFrame:
    """How much was paid under each contract."""
    return payments.groupBy("ssylka_fl", "ref_kodinsz", "data_nach_vypl").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("summa").alias("paid")
    )
