"""Disability records and payment restrictions of the legacy system."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pensio.functions.semantics import OPEN_END, asc, day, month_start, strict_least
from pensio.operators.intervals import count_in_ranges, interval_join, next_on_or_after
from pensio.operators.ordering import windowed
from pensio.plans.contracts import SKIPPED_CONTRIBUTOR
from pensio.sources.snapshots import stage

# Participants whose archived disability records are left out.
ARCHIVED_INVALID_EXCLUSIONS = (311413, 218130, 786929, 188380, 491724)
# The restriction code that lists paid periods, so that the restriction is what lies between them.
INVERTED_CODE = 3
# First restriction code that is no payment restriction; account status of disabled participants;
# restrictions from this day on are open ends, not dates.
CODE_LIMIT = 100
DISABLED_STATUS = "и"
FAR_FUTURE = "2050-01-01"
CURRENT, ARCHIVE = "SP_OGR_PV", "SP_OGR_PV_ARH"

_INVALID = (
    "ssylka_fl", "grup_inv", "data_zakl_vtek", "nom_zakl_vtek", "summa_ips", "summa_rsf", "summa_ips_u",
    "summa_ips_f", "pereosv", "data_pens",
)
_RESTRICTION = (
    "nom_vkl", "nom_ips", "kod_ogr_pv", "nach_deistv", "okon_deistv", "primech", "ssylka_fl", "kod_insz",
    "ssylka_td", "rid_td", "id",
)


def sp_invalid(
    current: DataFrame, archive: DataFrame, archive_exclusions=ARCHIVED_INVALID_EXCLUSIONS
) -> DataFrame:
    """Current and archived disability records; archived dates are dd.mm.yyyy text and must parse."""
    archived = archive.where(~F.col("ssylka_fl").isin(*archive_exclusions)).select(
        F.lit("SP_INVALID_ARH").alias("tbl"),
        *[F.col("dat_zakl_vtek").alias(c) if c == "data_zakl_vtek"
          else F.to_date(c, "dd.MM.yyyy").alias(c) if c in ("pereosv", "data_pens")
          else F.col(c) for c in _INVALID],
    )
    return current.select(F.lit("SP_INVALID").alias("tbl"), *_INVALID).unionByName(archived)


def sp_ogr_pv(current: DataFrame, archive: DataFrame, sp_lspv: DataFrame, invalid: DataFrame) -> DataFrame:
    """Current and archived payment restrictions.

    A current restriction of the inverted code counts only for a disabled participant: one whose account says
    so, or who has a disability record.
    """
    def wanted(df):
        return df.where((F.col("kod_ogr_pv") < CODE_LIMIT) & (F.col("nom_vkl") != SKIPPED_CONTRIBUTOR))

    disabled = (
        sp_lspv.where(F.col("status_pen") == DISABLED_STATUS)
        .select("ssylka_fl")
        .unionByName(invalid.select("ssylka_fl"))
        .distinct()
        .withColumn("_disabled", F.lit(True))
    )
    counts = (F.col("kod_ogr_pv") != INVERTED_CODE) | F.col("_disabled")
    now = wanted(current).join(disabled, "ssylka_fl", "left").where(counts)
    return now.select(F.lit(CURRENT).alias("source_table"), *_RESTRICTION).unionByName(
        wanted(archive).select(F.lit(ARCHIVE).alias("source_table"), *_RESTRICTION)
    )


def sp_ogr_pv_rev(restrictions: DataFrame) -> DataFrame:
    """Restrictions with the inverted code turned into the gaps between its periods.

    Such a row starts the day after its own end and ends the day before the participant's next row of that code
    starts. Only these rows are brought together, and only as one row per participant and start day: a row that
    is not the last of its day is followed by another start on the same day.
    """
    inverted = F.col("kod_ogr_pv") == INVERTED_CODE
    place = F.struct("id", "source_table")
    days = (
        restrictions.where(inverted)
        .groupBy("ssylka_fl", "nach_deistv")
        .agg(F.max(place).alias("_last"))
        .select(F.col("ssylka_fl").alias("_fl"), F.col("nach_deistv").alias("_d"), "_last")
    )
    days = days.withColumn("_next", F.lead("_d").over(Window.partitionBy("_fl").orderBy(*asc("_d"))))
    # One pass over the restrictions: only an inverted one finds its day, the others keep their dates.
    same = inverted & F.col("ssylka_fl").eqNullSafe(F.col("_fl")) & F.col("nach_deistv").eqNullSafe(F.col("_d"))
    following = F.when(place < F.col("_last"), F.col("nach_deistv")).otherwise(F.col("_next"))
    start = F.when(inverted, F.date_add("okon_deistv", 1)).otherwise(F.col("nach_deistv"))
    end = F.when(inverted, F.date_sub(following, 1)).otherwise(F.col("okon_deistv"))
    return restrictions.join(days, same, "left").select(
        "source_table", "nom_vkl", "nom_ips", "kod_ogr_pv", start.alias("nach_deistv"),
        end.alias("okon_deistv"), "primech", "ssylka_fl", "kod_insz", "ssylka_td", "rid_td", "id",
        F.col("nach_deistv").alias("real_nach_deistv"), F.col("okon_deistv").alias("real_okon_deistv"),
    )


def restrictions_by_contract(
    rev: DataFrame, periods: DataFrame, vypl_pen: DataFrame, starts: DataFrame | None = None, *, fixed: bool = False
) -> DataFrame:
    """Restrictions with the contract that holds their real start, a cancel flag and a rank among equals.

    A restriction is cancelled when it is archived, when it ends no later than it starts, or when it is an
    open-ended gap in which a payment was accrued before the contract's end. Among restrictions of one
    participant, contract start and start the archived come first, then the longest, then code and real start.
    The rank and count run over the un-nulled end, the output blanks an end that lies before the start.

    The source system also cancels a closed gap when its number of paid days equals a months_between that is
    never a whole number; that test is always false and therefore absent here. With ``fixed`` it is the test that was
    meant: the gap is cancelled when as many distinct days were paid, from the month of its start to that of its end or
    of the contract's, as the gap touches months.

    ``starts`` may name a cheap DataFrame (first column a date) covering the restriction start dates; it saves
    evaluating ``rev`` once more to learn the years that occur.
    """
    usable = rev.where(
        (F.col("nach_deistv") < day(FAR_FUTURE))
        & (
            (F.col("kod_ogr_pv") != INVERTED_CODE)
            | F.col("real_okon_deistv").isNotNull()
            | (F.col("source_table") == ARCHIVE)
        )
    )
    open_gap = (
        (F.col("kod_ogr_pv") == INVERTED_CODE)
        & F.col("okon_deistv").isNull()
        & (F.col("source_table") == CURRENT)
    )
    # The days asked for are few (the last gap of each disabled participant) and are read twice.
    gaps = stage(usable.where(open_gap).select("ssylka_fl", "nach_deistv").distinct())
    next_paid = next_on_or_after(
        gaps,
        vypl_pen.join(gaps.select("ssylka_fl"), "ssylka_fl", "left_semi"),
        key="ssylka_fl",
        day="nach_deistv",
        mark="data_nachisl",
        out="_next_paid",
    )
    marked = usable.join(next_paid, ["ssylka_fl", "nach_deistv"], "left")

    # A contract's interval of days: unlike the month-aligned one it starts and ends on the contract's own days.
    contract = periods.select(
        F.col("ssylka").alias("ssylka_fl"),
        "data_nach_vypl",
        "status_pen",
        "to_date",
        F.col("ref_kodinsz").alias("_contract"),
        F.when(F.col("dog_rn") == 1, F.col("from_date")).otherwise(F.col("data_nach_vypl")).alias("_lo"),
        F.when(F.col("dog_rn") == F.col("dog_cnt"), F.col("to_date"))
        .otherwise(F.coalesce("data_okon_vypl", day(OPEN_END)))
        .alias("_hi"),
    )
    held = interval_join(
        marked, contract, key="ssylka_fl", point="real_nach_deistv", lo="_lo", hi="_hi", years=starts
    )

    ends_before = F.col("okon_deistv") <= F.col("nach_deistv")
    paid_in_gap = open_gap & (F.col("_next_paid") <= F.col("to_date"))
    cancelled = (F.col("source_table") == ARCHIVE) | ends_before | paid_in_gap
    if fixed:
        months = F.months_between(month_start("okon_deistv"), month_start("nach_deistv")).cast("int") + 1
        closed = (F.col("kod_ogr_pv") == INVERTED_CODE) & F.col("okon_deistv").isNotNull()
        ranges = held.withColumns({
            "_from": F.when(closed, month_start("nach_deistv")),
            "_until": F.when(closed, F.last_day(strict_least(F.col("okon_deistv"), F.col("to_date")))),
        })
        held = count_in_ranges(
            stage(ranges), vypl_pen, key="ssylka_fl", lo="_from", hi="_until", mark="data_nachisl", out="_paid_days"
        )
        cancelled = cancelled | (closed & (F.col("_paid_days") == months))
    judged = held.select(
        *rev.columns,
        "data_nach_vypl",
        "status_pen",
        F.when(cancelled, "Y").otherwise("N").alias("is_cancel"),
        F.when(F.col("source_table") == CURRENT, 2).otherwise(1).alias("_source"),
        F.datediff("nach_deistv", F.coalesce("okon_deistv", day(OPEN_END))).alias("_minus_length"),
        "_contract",
    )
    ranked = windowed(
        judged,
        ["ssylka_fl", "data_nach_vypl", "nach_deistv"],
        ["_source", "_minus_length", "kod_ogr_pv", "real_nach_deistv", "id", "_contract"],
        bucket=[F.col("_source"), F.col("_minus_length")],
        rn="rn",
        cnt="cnt",
    )
    return ranked.select(
        "source_table", "nom_vkl", "nom_ips", "kod_ogr_pv", "nach_deistv",
        F.when(F.col("okon_deistv") >= F.col("nach_deistv"), F.col("okon_deistv")).alias("okon_deistv"),
        "primech", "ssylka_fl", "kod_insz", "ssylka_td", "rid_td", "id", "real_nach_deistv",
        "real_okon_deistv", "data_nach_vypl", "status_pen", "is_cancel", "cnt", "rn",
    )
