"""Schemas of the input tables, and the rules their definitions declare."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from pensio.operators.constraints import Check, Digits, ForeignKey, Length, NotNull, Rule, Unique

_CONTRACT = (
    "nom_vkl long, nom_ips long, fio string, data_otkr date, ssylka long, data_nach_vypl date, "
    "data_okon_vypl date, razm_pen decimal(12,2), delta_pen decimal(12,2), delta_pere decimal(12,2), "
    "summa decimal(12,2), summa_u decimal(12,2), summa_c decimal(12,2), data_dog date, nom_dog string, "
    "flag int, kod_oper int, flg_admin int, data date, sopr_oper int, nom_pz long, type_dog int, "
    "data_uvoln date, shema_dog int, data_perevoda_5_cx date, id_period_payment int, id_letter long, "
    "ref_kodinsz long, kod_insz long, summa_perevoda_5_cx decimal(12,2)"
)
_INVALID = (
    "ssylka_fl long, grup_inv int, {} date, nom_zakl_vtek string, summa_ips decimal(12,2), "
    "summa_rsf decimal(12,2), summa_ips_u decimal(12,2), summa_ips_f decimal(12,2), "
    "pereosv {}, data_pens {}"
)
_RESTRICTION = (
    "nom_vkl long, nom_ips long, kod_ogr_pv int, nach_deistv date, okon_deistv date, primech string, "
    "ssylka_fl long, kod_insz long, ssylka_td long, rid_td long, id long"
)

_DDL = {
    # legacy
    "sp_pen_dog": _CONTRACT,
    "sp_pen_dog_arh": _CONTRACT + ", data_arh timestamp_ntz",
    "sp_lspv": "ssylka_fl long, status_pen string, nach_vypl_pen date, data_zakr date",
    "vypl_pen": (
        "ssylka_fl long, data_op date, data_nachisl date, tip_vypl int, summa decimal(12,2), "
        "oplach_dni int, nom_vkl long, nom_ips long, ssylka_doc long"
    ),
    "sp_ogr_pv": _RESTRICTION,
    "sp_ogr_pv_arh": _RESTRICTION,
    "sp_invalid": _INVALID.format("data_zakl_vtek", "date", "date"),
    "sp_invalid_arh": _INVALID.format("dat_zakl_vtek", "string", "string"),
    "reer_doc_ngpf": (
        "ssylka long, ref_kodinsz long, tip_doc int, data_doc date, kem_podpis string, kr_soderg string, "
        "kod_insz long"
    ),
    "izmeneniya": (
        "nom_izm long, kod_izm int, kod_doc int, kod_oper int, data_otrab date, data_zanes date, kod_sost int"
    ),
    "izm_key_val": "nom_izm long, nom_trans int, fld_nom int, val string",
    "izm_spr_soderg": "kod_izm int, soderg string",
    "sp_izm_pd": (
        "ssylka_fl long, nom_izm long, data_izm date, summa_izm decimal(12,2), otpechatano int, "
        "ssylka_doc long, mod_pism int, data_pism date, sagenev string, dat_zanes date, no_otpr int, "
        "coment string, id long, sostoyanie int, forma int"
    ),
    "sp_ips": "ssylka_fl long, nom_vkl long, nom_ips long, tip_lits int",
    "dv_sr_ips": (
        "nom_vkl long, nom_ips long, data_op date, summa decimal(12,2), shifr_schet int, sub_shifr_schet int"
    ),
    "kod_shifr_schet": "shifr_schet int, sub_shifr_schet int, ips int",
    # target
    "accounts": "id long, fk_scheme int, acct_number string, title string, fk_acct_type int",
    "accounts_balance": "fk_account long, transfer_date date, amount decimal(10,2), update_date date",
    "contracts": (
        "fk_document long, cntr_number long, fk_account long, fk_company long, fk_scheme int, "
        "fk_contragent long, fk_cntr_type int"
    ),
    "pension_agreements": (
        "fk_contract long, fk_base_contract long, state int, period_code int, isarhv int, fk_pay_detail long, "
        "effective_date date, expiration_date date, amount decimal(12,2), creation_date date, "
        "last_update date, date_pension_age date"
    ),
    "pension_agreement_addendums": (
        "id long, fk_pension_agreement long, fk_provacct long, serialno long, amount decimal(12,2), "
        "alt_date_begin date, alt_date_end date, canceled long, creation_date date"
    ),
    "pension_agreement_periods": (
        "fk_pension_agreement long, calc_date date, check_date date, creation_date timestamp_ntz, "
        "pa_effective_date date, is_disabled_pa string"
    ),
    "pay_restrictions": (
        "id long, fk_doc_with_acct long, effective_date date, expiration_date date, fk_document_cancel long"
    ),
    "pay_orders": (
        "fk_document long, payment_period date, operation_date date, payment_freqmask string, "
        "scheduled_date date, calculation_date date, fk_pay_order_type int, export_err_count int"
    ),
    "pay_order_filters": "id long, fk_pay_order long, filter_code string, filter_value long",
    "documents": "id long, doc_date date, title string, is_accounting_doc int",
    "transform_contragents": "fk_contract long, ssylka_fl long, ssylka_ts long",
    "debt_withholdings": "fk_debt_assignment long",
    "assignments": (
        "id long, fk_doc_with_action long, fk_doc_with_acct long, fk_debit long, fk_credit long, "
        "fk_asgmt_type int, fk_contragent long, paydate date, amount decimal(12,2), "
        "amount_detail decimal(12,2), paytax decimal(12,2), fk_paycode int, paydays int, fk_scheme int, "
        "comments string, asgmt_state int, fk_created long, fk_prepared long, fk_pay_payment long, "
        "fk_pay_refund_type int, isexists int, isauto int, iscancel int, serv_doc long, serv_date date, "
        "creation_date timestamp_ntz, fk_registry long, direction int"
    ),
    # mapping and control
    "transform_pa": (
        "ssylka_fl long, date_nach_vypl date, fk_base_contract long, fk_contragent long, ref_kodinsz long, "
        "fk_contract long, source_table string, data_arh timestamp_ntz"
    ),
    "transform_pa_portfolios": (
        "ssylka_fl long, date_nach_vypl date, source_table string, pd_creation_date date, change_date date, "
        "kod_izm long, kod_doc long, nom_izm long, true_kod_izm string, fk_document long, "
        "fk_pay_portfolio long, fk_pay_decision long"
    ),
    "transform_pa_restrictions": (
        "import_id string, ssylka long, fk_contragent long, fk_contract long, kod_ogr_pv int, "
        "primech string, nach_deistv date, okon_deistv date, fnd_nach_deistv date, fnd_okon_deistv date, "
        "fk_pay_restriction long, is_cancel string, cnt long, rn long"
    ),
    "transform_pa_accounts": (
        "account_type string, ssylka_fl long, pa_effective_date date, fk_contragent long, "
        "fk_base_contract long, fk_contract long, cntr_number long, fk_scheme int, pa_expiration_date date, "
        "fk_account long, source_table string"
    ),
    "transform_po": (
        "ssylka_doc long, flag_usage int, rn long, max_half_month int, operation_date date, "
        "payment_period date, half_month int, fk_document long"
    ),
    "transform_pa_assignments": (
        "date_op date, ssylka_doc long, fk_pay_order long, import_id string, state string, "
        "creation_date timestamp_ntz, last_update_date timestamp_ntz"
    ),
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[table])


def table_names() -> list[str]:
    return list(_DDL)


def rules(table: str, parents: dict[str, DataFrame] | None = None) -> list[Rule]:
    """Rules the table's definition declares; foreign keys only for the parent tables given."""
    found = list(_RULES.get(table, ()))
    for columns, parent, parent_columns in _FOREIGN_KEYS.get(table, ()):
        if parents and parent in parents:
            found.append(ForeignKey(columns, parents[parent], parent_columns))
    return found


def _whole(columns: str) -> tuple[Rule, ...]:
    """Columns declared as whole numbers of ten digits."""
    return tuple(Digits(c, 10) for c in columns.split())


# What a column gets where a row brings nothing. ``sysdate`` is the run time, an argument.
_DEFAULTS = {
    "transform_pa_assignments": {"state": "N"},
    "pension_agreement_periods": {"creation_date": "sysdate"},
    "assignments": {
        "amount": 0, "amount_detail": 0, "paytax": 0, "paydays": 0, "asgmt_state": 0, "isexists": 0, "isauto": 0,
        "iscancel": 0, "direction": 1, "creation_date": "sysdate",
    },
}


def defaults(table: str, run_time: dt.datetime) -> dict[str, Column]:
    """Default values of a table's columns, for ``append_with_rejects``. Ids are its ``ids`` argument."""
    return {c: F.lit(run_time if v == "sysdate" else v) for c, v in _DEFAULTS.get(table, {}).items()}


_RULES: dict[str, tuple[Rule, ...]] = {
    "accounts_balance": (
        NotNull("fk_account"),
        NotNull("update_date"),
        Digits("fk_account", 10),
        Unique(("fk_account",)),
    ),
    "pay_order_filters": (
        NotNull("id"),
        NotNull("fk_pay_order"),
        Length("filter_code", 10),
        Check("filter_code is COMPANY or CONTRACT", "filter_code in ('COMPANY', 'CONTRACT')"),
        Unique(("id",)),
    ),
    "pension_agreements": (
        Check("date_pension_age is a month start", "date_pension_age = trunc(date_pension_age, 'MM')"),
    ),
    "pension_agreement_periods": (
        NotNull("fk_pension_agreement"),
        NotNull("calc_date"),
        NotNull("check_date"),
        NotNull("pa_effective_date"),
        Digits("fk_pension_agreement", 10),
        Length("is_disabled_pa", 1),
        Unique(("fk_pension_agreement",)),
    ),
    "transform_pa": (
        NotNull("ssylka_fl"),
        NotNull("date_nach_vypl"),
        NotNull("source_table"),
        Length("source_table", 32),
        Unique(("ssylka_fl", "date_nach_vypl")),
        Unique(("source_table", "ssylka_fl", "data_arh")),
    ),
    "transform_pa_portfolios": (
        NotNull("ssylka_fl"),
        NotNull("date_nach_vypl"),
        Length("source_table", 32),
        Length("true_kod_izm", 1),
        *_whole("kod_izm kod_doc nom_izm fk_document fk_pay_portfolio fk_pay_decision"),
        Unique(("ssylka_fl", "date_nach_vypl")),
    ),
    "transform_pa_restrictions": (
        NotNull("import_id"),
        NotNull("ssylka"),
        NotNull("kod_ogr_pv"),
        NotNull("nach_deistv"),
        NotNull("fnd_nach_deistv"),
        Length("import_id", 14),
        Length("primech", 255),
        Length("is_cancel", 1),
        *_whole("ssylka fk_contragent fk_contract fk_pay_restriction"),
        Digits("kod_ogr_pv", 1),
        Digits("cnt", 2),
        Digits("rn", 2),
    ),
    "transform_pa_accounts": (
        NotNull("account_type"),
        NotNull("ssylka_fl"),
        NotNull("pa_effective_date"),
        NotNull("source_table"),
        Length("account_type", 2),
        Length("source_table", 32),
        *_whole("ssylka_fl fk_contragent fk_base_contract fk_contract cntr_number fk_scheme fk_account"),
        Unique(("account_type", "ssylka_fl", "pa_effective_date")),
        Unique(("account_type", "fk_contract")),
    ),
    "transform_po": (
        NotNull("ssylka_doc"),
        *_whole("ssylka_doc fk_document"),
        Digits("flag_usage", 1),
        Digits("rn", 2),
        Digits("max_half_month", 1),
        Digits("half_month", 1),
        Unique(("ssylka_doc",)),
        Unique(("fk_document",)),
    ),
    "transform_pa_assignments": (
        NotNull("date_op"),
        NotNull("fk_pay_order"),
        NotNull("import_id"),
        Length("import_id", 14),
        Length("state", 1),
        *_whole("ssylka_doc fk_pay_order"),
        Unique(("date_op", "ssylka_doc")),
    ),
}
# (columns, parent table, parent columns)
_FOREIGN_KEYS = {
    "accounts_balance": ((("fk_account",), "accounts", ("id",)),),
    "pay_order_filters": ((("fk_pay_order",), "pay_orders", ("fk_document",)),),
    "pension_agreement_periods": ((("fk_pension_agreement",), "pension_agreements", ("fk_contract",)),),
    "debt_withholdings": ((("fk_debt_assignment",), "assignments", ("id",)),),
}
