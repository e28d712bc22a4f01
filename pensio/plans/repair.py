"""Data repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed value: plan type outside pension agreements.
MANDATORY_SCHEME = 7


def backfill_contract_ref(
    sp_pen_dog: DataFrame,
    agreements: DataFrame,
    contracts: DataFrame,
    transform_contragents: DataFrame,
    *,
    strict: bool = False,
) -> DataFrame:
    """Fills ``ref_kodinsz`` from the agreement that matches an unlinked contract in start and amount.

    As at the source, once one of a participant's contracts matches, all of the participant's contracts get the
    reference, linked or not. Of several matching agreements the highest wins, where the source leaves it open.
    With ``strict`` only the unlinked contracts that match themselves get it.
    """
    unlinked = sp_pen_dog.where(F.col("ref_kodinsz").isNull()).select(
        "ssylka", F.col("data_nach_vypl").alias("effective_date"), F.col("razm_pen").alias("amount")
    ).distinct()
    owner = transform_contragents.select(
        F.col("fk_contract").alias("fk_base_contract"), F.col("ssylka_fl").alias("ssylka")
    )
    base = contracts.select(F.col("fk_document").alias("fk_base_contract"))
    matched = ["ssylka", "effective_date", "amount"]
    by = matched if strict else ["ssylka"]
    found = (
        agreements.select("fk_contract", "fk_base_contract", "effective_date", "amount")
        .join(base, "fk_base_contract", "left_semi")
        .join(owner, "fk_base_contract")
        .join(unlinked, matched)
        .groupBy(*[F.col(c).alias(f"_{c}") for c in by])
        .agg(F.max("fk_contract").alias("_found"))
    )
    here = F.col("ssylka") == F.col("_ssylka")
    new = F.coalesce("_found", "ref_kodinsz")
    if strict:
        here &= (F.col("data_nach_vypl") == F.col("_effective_date")) & (F.col("razm_pen") == F.col("_amount"))
        here &= F.col("ref_kodinsz").isNull()
    return sp_pen_dog.join(found, here, "left").withColumn("ref_kodinsz", new).select(sp_pen_dog.columns)


def contracts_without_agreement(sp_pen_dog: DataFrame, agreements: DataFrame) -> DataFrame:
    """Contracts, other than those of the mandatory scheme, that no agreement refers to."""
    return sp_pen_dog.where(F.col("shema_dog") != MANDATORY_SCHEME).join(
        agreements.select(F.col("fk_contract").alias("ref_kodinsz")), "ref_kodinsz", "left_anti"
    ).select(sp_pen_dog.columns)
