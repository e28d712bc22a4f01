"""Hand-made rows for each rule that is easy to get wrong."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pensio.functions import semantics as s
from pensio.operators.intervals import interval_join, next_on_or_after
from pensio.plans import agreements, contracts, reconcile, registry, reports, restrictions

D = dt.date


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_strict_extremes(spark):
    a, b, null = F.lit(1), F.lit(2), F.lit(None).cast("int")
    assert one(spark, s.strict_greatest(a, b)) == 2
    assert one(spark, s.strict_greatest(a, null)) is None
    assert one(spark, s.strict_least(null, b)) is None
    assert one(spark, s.text(F.lit("a"), F.lit(None), F.lit(1))) == "a1"


def test_period_starts(spark):
    day = F.lit(D(2018, 8, 15))
    assert one(spark, s.month_start(day)) == D(2018, 8, 1)
    assert one(spark, s.quarter_start(day)) == D(2018, 7, 1)
    assert one(spark, s.year_start(day)) == D(2018, 1, 1)


def test_half_up_division(spark):
    divide = lambda n, d: one(spark, s.divide_half_up(F.lit(n), F.lit(d)))
    assert [divide(5, 2), divide(-5, 2), divide(7, 3), divide(-7, 3), divide(0, 31)] == [3, -3, 2, -2, 0]


def contracts_of(table, *starts, excluded=None, archive=()):
    lspv = table("sp_lspv", dict(ssylka_fl=1, status_pen="п", nach_vypl_pen=D(1999, 1, 1)))
    current = table(
        "sp_pen_dog",
        *[dict(nom_vkl=5, ssylka=1, data_nach_vypl=d, ref_kodinsz=i, shema_dog=2) for i, d in enumerate(starts)],
    )
    old = table(
        "sp_pen_dog_arh",
        *[dict(nom_vkl=5, ssylka=k, data_nach_vypl=D(1990, 1, 1), ref_kodinsz=100 + i, data_arh=t)
          for i, (k, t) in enumerate(archive)],
    )
    return contracts.pension_contracts(current, lspv, old, excluded)


def test_contract_interval_leaves_a_gap_before_the_first_of_a_month(table):
    periods = contracts.contract_periods(contracts_of(table, D(2000, 1, 10), D(2000, 5, 1), D(2001, 3, 20)))
    got = [(r["from_date"], r["to_date"]) for r in periods.orderBy("dog_rn").collect()]
    assert got == [
        (D(1, 1, 1), D(2000, 3, 31)),  # April 2000 belongs to no contract
        (D(2000, 5, 1), D(2001, 2, 28)),
        (D(2001, 3, 1), D(9999, 12, 31)),
    ]


def test_two_contracts_in_one_month(table):
    periods = contracts.contract_periods(
        contracts_of(table, D(2000, 1, 1), D(2000, 5, 10), D(2000, 5, 20))
    ).orderBy("dog_rn")
    middle = periods.collect()[1]
    assert middle["to_date"] < middle["from_date"]
    pay = table("vypl_pen", dict(ssylka_fl=1, data_nachisl=D(2000, 5, 12), summa=Decimal(1)))
    assert [r["ref_kodinsz"] for r in contracts.payments_by_contract(pay, periods).collect()] == [2]


def test_equal_and_missing_starts(table):
    got = contracts_of(table, D(2000, 5, 1), None, D(2000, 5, 1)).orderBy("dog_rn").collect()
    assert [(r["ref_kodinsz"], r["data_okon_vypl"]) for r in got] == [(0, D(2000, 4, 30)), (2, None), (1, None)]
    assert {r["dog_cnt"] for r in got} == {3}


def test_archive_exclusions_follow_three_valued_logic(spark, table):
    t1, t2 = dt.datetime(2004, 5, 9, 17, 33, 44), dt.datetime(2010, 1, 1)
    excluded = contracts.exclusions(spark, [(7, t1.isoformat())])
    rows = [(7, t1), (7, t2), (7, None), (8, t1), (8, None), (None, t1), (None, t2), (None, None)]
    old = table("sp_pen_dog_arh", *[dict(ssylka=k, data_arh=t) for k, t in rows])
    names = ("ssylka", "data_arh"), ("ssylka_fl", "data_arh")
    kept = contracts.not_in_pairs(old, excluded, *names).select("ssylka", "data_arh").collect()
    assert {tuple(r) for r in kept} == {(7, t2), (8, t1), (8, None), (None, t2)}
    everything = contracts.not_in_pairs(old, excluded.limit(0), *names)
    assert everything.count() == len(rows)


def test_default_exclusions_and_skipped_contributor(table):
    k, t = contracts.CONTRACT_EXCLUSIONS[0]
    got = contracts_of(table, archive=[(k, dt.datetime.fromisoformat(t)), (k, dt.datetime(2004, 5, 9))])
    assert [r["data_arh"] for r in got.collect()] == [dt.datetime(2004, 5, 9)]
    skipped = table("sp_pen_dog", dict(nom_vkl=contracts.SKIPPED_CONTRIBUTOR, ssylka=1))
    empty = table("sp_pen_dog_arh"), table("sp_lspv")
    assert contracts.pension_contracts(skipped, empty[1], empty[0]).count() == 0


def test_interval_join_bounds(spark):
    points = spark.createDataFrame(
        [(1, D(2000, 12, 31)), (1, D(2001, 1, 1)), (1, D(1990, 1, 1)), (2, D(2001, 1, 1)), (1, None)], "k int, p date"
    )
    spans = spark.createDataFrame(
        [(1, "a", D(1, 1, 1), D(2000, 12, 31)), (1, "b", D(2001, 1, 1), D(9999, 12, 31)),
         (1, "c", D(2002, 1, 1), D(2001, 1, 1)), (1, "d", None, D(2001, 1, 1))], "k int, n string, lo date, hi date"
    )
    got = interval_join(points, spans, key="k", point="p", lo="lo", hi="hi").select("p", "n").collect()
    assert {tuple(r) for r in got} == {(D(2000, 12, 31), "a"), (D(1990, 1, 1), "a"), (D(2001, 1, 1), "b")}


def test_next_on_or_after(spark):
    days = spark.createDataFrame([(1, D(2000, 1, 1)), (1, D(2000, 1, 5)), (1, D(2000, 1, 9)), (2, D(2000, 1, 1))], "k int, d date")
    marks = spark.createDataFrame([(1, D(2000, 1, 5)), (1, D(2000, 1, 5)), (1, D(2000, 1, 3)), (3, D(2000, 1, 1))], "k int, m date")
    got = next_on_or_after(days, marks, key="k", day="d", mark="m", out="n").collect()
    assert {tuple(r) for r in got} == {
        (1, D(2000, 1, 1), D(2000, 1, 3)), (1, D(2000, 1, 5), D(2000, 1, 5)), (1, D(2000, 1, 9), None),
        (2, D(2000, 1, 1), None),
    }


def restriction(i, code, start, end, **more):
    return dict(nom_vkl=5, kod_ogr_pv=code, nach_deistv=start, okon_deistv=end, ssylka_fl=1, id=i, **more)


def test_inverted_restrictions_are_the_gaps(table):
    current = table(
        "sp_ogr_pv",
        restriction(1, 3, D(2000, 1, 1), D(2000, 3, 31)),
        restriction(2, 3, D(2000, 6, 1), D(2000, 8, 31)),
        restriction(3, 3, D(2000, 6, 1), None),
        restriction(4, 1, D(2000, 1, 1), D(2000, 2, 1)),
        restriction(5, 120, D(2000, 1, 1), None),
    )
    lspv = table("sp_lspv", dict(ssylka_fl=1, status_pen="и"))
    invalid = restrictions.sp_invalid(table("sp_invalid"), table("sp_invalid_arh"))
    view = restrictions.sp_ogr_pv(current, table("sp_ogr_pv_arh"), lspv, invalid)
    got = {r["id"]: (r["nach_deistv"], r["okon_deistv"]) for r in restrictions.sp_ogr_pv_rev(view).collect()}
    assert got == {
        1: (D(2000, 4, 1), D(2000, 5, 31)),
        2: (D(2000, 9, 1), D(2000, 5, 31)),  # followed by a start on the same day
        3: (None, None),
        4: (D(2000, 1, 1), D(2000, 2, 1)),
    }
    healthy = table("sp_lspv", dict(ssylka_fl=1, status_pen="п"))
    assert {r["id"] for r in restrictions.sp_ogr_pv(current, table("sp_ogr_pv_arh"), healthy, invalid).collect()} == {4}


def test_cancel_flag(table):
    plain = [
        restriction(1, 1, D(2000, 1, 1), D(2000, 1, 1)),  # one day: cancelled, end kept
        restriction(2, 1, D(2000, 2, 1), D(2000, 1, 1)),  # ends before it starts: cancelled, end blanked
        restriction(3, 1, D(2000, 3, 1), D(2000, 5, 1)),
        restriction(4, 3, D(2000, 1, 1), D(2000, 6, 30)),  # open gap from July: paid in August
    ]
    lspv = table("sp_lspv", dict(ssylka_fl=1, status_pen="и"))
    invalid = restrictions.sp_invalid(table("sp_invalid"), table("sp_invalid_arh"))
    view = restrictions.sp_ogr_pv(table("sp_ogr_pv", *plain), table("sp_ogr_pv_arh"), lspv, invalid)
    periods = contracts.contract_periods(contracts_of(table, D(1995, 1, 1)))
    for day, flag in ((D(2000, 8, 1), "Y"), (D(2000, 6, 30), "N"), (D(2000, 7, 1), "Y")):
        pay = table("vypl_pen", dict(ssylka_fl=1, data_nachisl=day))
        got = restrictions.restrictions_by_contract(restrictions.sp_ogr_pv_rev(view), periods, pay)
        rows = {r["id"]: (r["okon_deistv"], r["is_cancel"], r["cnt"], r["rn"]) for r in got.collect()}
        assert rows == {
            1: (D(2000, 1, 1), "Y", 1, 1), 2: (None, "Y", 1, 1), 3: (D(2000, 5, 1), "N", 1, 1), 4: (None, flag, 1, 1),
        }


def test_rank_prefers_archive_then_longest(table):
    day = D(2000, 1, 1)
    current = table("sp_ogr_pv", restriction(1, 1, day, D(2000, 2, 1)), restriction(2, 2, day, None), restriction(3, 1, day, None))
    archive = table("sp_ogr_pv_arh", restriction(4, 9, day, D(2000, 1, 5)))
    invalid = restrictions.sp_invalid(table("sp_invalid"), table("sp_invalid_arh"))
    view = restrictions.sp_ogr_pv(current, archive, table("sp_lspv"), invalid)
    periods = contracts.contract_periods(contracts_of(table, D(1995, 1, 1)))
    got = restrictions.restrictions_by_contract(restrictions.sp_ogr_pv_rev(view), periods, table("vypl_pen"))
    assert [(r["id"], r["cnt"]) for r in got.orderBy("rn").collect()] == [(4, 4), (3, 4), (2, 4), (1, 4)]


def test_archived_disability_dates_and_exclusions(table):
    rows = [dict(ssylka_fl=k, pereosv="05.11.2001", data_pens="29.02.2000") for k in (311413, 5)]
    got = restrictions.sp_invalid(table("sp_invalid", dict(ssylka_fl=311413)), table("sp_invalid_arh", *rows)).collect()
    assert {(r["tbl"], r["ssylka_fl"], r["pereosv"], r["data_pens"]) for r in got} == {
        ("SP_INVALID", 311413, None, None),
        ("SP_INVALID_ARH", 5, D(2001, 11, 5), D(2000, 2, 29)),
    }


def segments(table, *rows):
    return agreements.addendum_segments(
        table(
            "pension_agreement_addendums",
            *[dict(id=i, fk_pension_agreement=1, serialno=i, alt_date_begin=d, fk_provacct=10 + i, canceled=c,
                   amount=None if a is None else Decimal(a)) for i, (d, a, c) in enumerate(rows)],
        )
    )


def test_first_month_is_prorated(table):
    got = agreements.addendum_months(
        segments(table, (D(2018, 1, 1), "100.00", 0), (D(2018, 4, 11), "400.00", 0), (D(2018, 4, 21), "250.00", 0))
    )
    rows = {r["from_date"]: r for r in got.collect()}
    april = rows[D(2018, 4, 1)]
    # 10 days of the old amount, 10 of the first new one, 10 of the second; the amount is the month's largest.
    assert april["first_amount"] == Decimal("250.00")
    assert (april["amount"], april["fk_provacct"]) == (Decimal("400.00"), 12)
    assert april["end_date"] == D(4712, 12, 31)
    assert (rows[D(2018, 1, 1)]["end_date"], rows[D(2018, 1, 1)]["first_amount"]) == (D(2018, 3, 31), Decimal("100.00"))


def test_half_cent_rounds_away_from_zero(table):
    # 15 of 30 days of one cent is half a cent.
    got = agreements.addendum_months(segments(table, (D(2018, 4, 16), "0.01", 0))).first()
    assert got["first_amount"] == Decimal("0.01")


def test_missing_amount_drops_the_whole_term(table):
    got = agreements.addendum_months(segments(table, (D(2018, 1, 1), "100.00", 0), (D(2018, 4, 11), None, 0)))
    assert {r["from_date"]: r["first_amount"] for r in got.collect()} == {
        D(2018, 1, 1): Decimal("100.00"),
        D(2018, 4, 1): None,
    }


def test_cancelled_addenda_do_not_count_and_same_day_ones_are_empty(table):
    got = segments(table, (D(2018, 1, 5), "1.00", 0), (D(2018, 1, 9), "2.00", 3), (D(2018, 1, 5), "3.00", 0))
    rows = got.orderBy("serialno").collect()
    assert [(r["serialno"], r["month_serialno"], r["end_date"]) for r in rows] == [
        (0, 1, D(2018, 1, 4)),
        (2, 2, D(4713, 1, 1)),
    ]
    assert rows[1]["amount_prev"] == Decimal("1.00")


def registry_row(table, text, day=None, i=1):
    return registry.registry_pay_orders(table("reer_doc_ngpf", dict(ssylka=i, kr_soderg=text, data_doc=day))).first()


@pytest.mark.parametrize(
    "text, day, i, want",
    [
        ("Закрыть ИПС, выплата пенсий, первая половина, май 1998", None, 1, D(1998, 5, 10)),
        ("Закрыть ИПС, выпл. пенсий втор.пол. сентябрь 1999 г.", None, 1, D(1999, 9, 25)),
        ("Закрыть ИПС, выплата пенсий за март", D(2001, 7, 30), 1, D(1996, 3, 30)),
        ("Закрыть ИПС, выплата пенсий 2003", D(2001, 7, 30), 1, D(2003, 7, 30)),
        ("Закрыть ИПС, выплата пенсий", None, 531, D(1997, 1, 1)),
        ("Закрыть ИПС, выплата пенсий за июль", None, 414, D(1996, 7, 1)),
        ("Закрыть ИПС, выплата пенсий 12345 за июнь и май 2001", None, 1, D(2001, 6, 1)),
    ],
)
def test_registry_texts(table, text, day, i, want):
    got = registry_row(table, text, day, i)
    assert got["operation_date"] == want
    assert got["payment_period"] == want.replace(day=1)
    assert got["half_month"] == (1 if want.day < 15 else 2)


def test_registry_texts_that_are_no_pay_orders(table):
    for text in ("Закрыть ИПС", "Открыть ИПС, выплата пенсий", "закрыть ИПС, выплата пенсий", "Закрыть ИПС пенсии выплатить"):
        assert registry_row(table, text, D(2000, 1, 1)) is None
    assert registry_row(table, "Закрыть ИПС, выплата пенсий", D(2000, 1, 1), 48) is None


def test_registry_exceptions_and_impossible_day(table):
    got = registry_row(table, "любой текст", D(2000, 1, 20), 13906)
    assert (got["flag_usage"], got["operation_date"], got["payment_period"]) == (2, D(2000, 1, 20), D(2000, 1, 1))
    with pytest.raises(Exception, match="DATETIME_FIELD_OUT_OF_BOUNDS|Invalid"):
        registry_row(table, "Закрыть ИПС, выплата пенсий за июнь 2001", D(2001, 7, 31))


def test_change_date_patch(table):
    got = registry.sp_izm_pd(table("sp_izm_pd", dict(id=2060058, data_izm=D(2000, 1, 1)), dict(id=1, data_izm=D(2000, 1, 1))))
    assert {r["id"]: r["data_izm"] for r in got.collect()} == {2060058: D(2006, 11, 28), 1: D(2000, 1, 1)}


def test_agreement_end_is_open(table):
    contract = lambda i, **more: dict(fk_document=i, fk_scheme=1, fk_account=i + 10, **more)
    view = agreements.pension_agreements(
        table("pension_agreements", dict(fk_contract=1, fk_base_contract=2, state=1, isarhv=0)),
        table("contracts", contract(1, fk_cntr_type=6), contract(2, fk_cntr_type=1)),
    )
    row = agreements.agreements_active(view).first()
    assert (row["fk_credit"], row["fk_debit"], row["last_pay_date"]) == (11, 12, D(9999, 12, 31))


def test_a_run_equals_itself(table):
    run = table("assignments", dict(fk_doc_with_acct=1, fk_asgmt_type=2, paydate=D(2000, 1, 1), amount=Decimal("1.00")))
    contract = lambda i, t: dict(fk_document=i, fk_scheme=1, fk_cntr_type=t)
    terms = agreements.agreement_periods(
        table("pension_agreement_periods", dict(fk_pension_agreement=1)),
        agreements.agreements_active(
            agreements.pension_agreements(
                table("pension_agreements", dict(fk_contract=1, fk_base_contract=2, state=1, isarhv=0)),
                table("contracts", contract(1, 6), contract(2, 1)),
            )
        ),
    )
    balances = table("accounts_balance")
    assert reconcile.reconcile_assignments(run, run, terms, balances).count() == 0
    other = run.withColumn("amount", F.lit(Decimal("1.01")))
    got = reconcile.reconcile_assignments(run, other, terms, balances).first()
    assert (got["amount"], got["new_amount"], got["balance_debit"]) == (Decimal("1.00"), Decimal("1.01"), None)


def test_months_without_update_are_skipped_before_the_lag(table):
    at = lambda d, h=None: dict(date_op=d, last_update_date=h)
    got = reports.progress_by_month(
        table(
            "transform_pa_assignments",
            at(D(2000, 1, 5), dt.datetime(2000, 1, 5, 10)),
            at(D(2000, 2, 5)),
            at(D(2000, 3, 5), dt.datetime(2000, 1, 5, 10, 0, 50)),
        )
    ).collect()
    assert [(r["pay_month"], r["duration_min"]) for r in got] == [(D(2000, 1, 1), None), (D(2000, 3, 1), Decimal("0.83"))]
