"""Benchmark tables seen as the tables of the pension model.

Each mapping is one SELECT that Spark SQL and DuckDB both read: orders become contracts, agreements, restrictions
and registry documents, line items become payments, addenda and assignments, customers become participants and
accounts, events become the change log. ``{name}`` refers to another mapping or to a benchmark table; ``@TS``
stands for each engine's timestamp without time zone. All mappings read whole tables, and make the misses of outer
and anti joins by shifted keys. Some tables are a part of the rows by their meaning: current and archived contracts and
restrictions, participants with a disability, corrections (of some documents), and the second accrual run, which lacks
some accruals of the first.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from pensio.sources.snapshots import stage

BENCHMARK_TABLES = ("orders", "customer", "lineitem", "events")

# Participant number -> contributor number; one in 25 falls on the contributor that is left out.
_CONTRIBUTOR = "CAST({} % 25 + 989 AS BIGINT)"

_CONTRACT = f"""
  SELECT {_CONTRIBUTOR.format("c")} AS nom_vkl, c AS nom_ips, 'P' || CAST(c AS STRING) AS fio,
         d - 30 AS data_otkr, c AS ssylka, CASE WHEN price > 499000 THEN NULL ELSE d END AS data_nach_vypl,
         d + 365 AS data_okon_vypl, price AS razm_pen, CAST(pri AS DECIMAL(12,2)) AS delta_pen,
         CAST(0 AS DECIMAL(12,2)) AS delta_pere, price AS summa, price AS summa_u, price AS summa_c,
         d - 10 AS data_dog, 'N' || CAST(k AS STRING) AS nom_dog, pri % 2 AS flag, pri AS kod_oper,
         0 AS flg_admin, CASE WHEN pri = 5 THEN NULL ELSE d - 5 END AS data, pri AS sopr_oper, k AS nom_pz,
         pri AS type_dog, CAST(NULL AS DATE) AS data_uvoln, CAST(1 + k % 8 AS INT) AS shema_dog,
         CASE WHEN k % 8 = 4 THEN d + 100 ELSE NULL END AS data_perevoda_5_cx, pri AS id_period_payment,
         c AS id_letter, k AS ref_kodinsz, k AS kod_insz, price AS summa_perevoda_5_cx{{extra}}
  FROM   {{{{ord}}}} WHERE {{where}}"""

_RESTRICTION = f"""
  SELECT nom_vkl, nom_ips, kod_ogr_pv, nach_deistv,
         CASE WHEN k % 5 = 0 THEN NULL ELSE nach_deistv + CAST(k % 120 AS INT) - 5 END AS okon_deistv,
         'R' || CAST(k AS STRING) AS primech, c AS ssylka_fl, k AS kod_insz, k + 1 AS ssylka_td,
         k + 2 AS rid_td, k AS id
  FROM  (SELECT k, c, {_CONTRIBUTOR.format("c")} AS nom_vkl, c AS nom_ips,
                pri + CASE WHEN k % 97 = 0 THEN 100 ELSE 0 END AS kod_ogr_pv,
                CASE WHEN pri < 3 THEN make_date(year(d), month(d), 1)
                     ELSE d + CAST(k % 400 AS INT) - 200 END AS nach_deistv
         FROM {{{{ord}}}} WHERE {{where}}) r"""

# Assignments and addenda need a number that tells line items apart.
_LINE_ID = (
    "(k * 8 + n) * 100000000 + (((p * 131 + s) * 53 + q) * 7919 + CAST(price * 100 AS BIGINT)) % 99999989"
)
_OP = "(last_day(d) + 10)"
_ORDER_OF_OP = "8000000000 + CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS BIGINT)"

_ASSIGNMENT = f"""
  SELECT {_LINE_ID} AS id, {_ORDER_OF_OP.format(_OP)} AS fk_doc_with_action, k AS fk_doc_with_acct,
         7000000000 + k AS fk_debit, 6000000000 + k AS fk_credit,
         CASE WHEN ls = 'O' THEN 2 ELSE 1 END AS fk_asgmt_type, s AS fk_contragent, d AS paydate,
         {{amount}} AS amount, price AS amount_detail, CAST(NULL AS DECIMAL(12,2)) AS paytax, n AS fk_paycode,
         q AS paydays, CAST(s % 9 AS INT) AS fk_scheme, CAST(NULL AS STRING) AS comments, n AS asgmt_state,
         p AS fk_created, CAST(NULL AS BIGINT) AS fk_prepared, CAST(NULL AS BIGINT) AS fk_pay_payment,
         CAST(NULL AS INT) AS fk_pay_refund_type, 1 AS isexists, 0 AS isauto, CAST(NULL AS INT) AS iscancel,
         CAST(NULL AS BIGINT) AS serv_doc, CAST(NULL AS DATE) AS serv_date,
         CAST(NULL AS @TS) AS creation_date, CAST(NULL AS BIGINT) AS fk_registry,
         CASE WHEN rf = 'R' THEN -1 ELSE NULL END AS direction
  FROM   {{{{line}}}}{{where}}"""

MAPPINGS = {
    "ord": """
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, CAST(substr(o_orderpriority, 1, 1) AS INT) AS pri,
         CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(12,2)) AS price
  FROM   {orders}""",
    "line": """
  SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, CAST(l_quantity AS INT) AS q,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l_tax AS DECIMAL(4,2)) AS tax, l_returnflag AS rf, l_linestatus AS ls,
         CAST(l_shipdate AS DATE) AS d
  FROM   {lineitem}""",
    # legacy
    "sp_pen_dog": _CONTRACT.format(extra="", where="st = 'O'"),
    "sp_pen_dog_arh": _CONTRACT.format(
        extra=""",
         CASE WHEN pri = 4 THEN NULL ELSE CAST(d + CAST(k % 400 AS INT) AS @TS) END AS data_arh""",
        where="st <> 'O'",
    ),
    "contract_exclusions": """
  SELECT DISTINCT ssylka AS ssylka_fl, data_arh FROM {sp_pen_dog_arh}
  WHERE  data_arh IS NOT NULL AND razm_pen > 490000""",
    # The same contracts as sp_pen_dog, not yet linked to an agreement where the priority is high.
    "sp_pen_dog_unlinked": _CONTRACT.format(extra="", where="st = 'O'").replace(
        "k AS ref_kodinsz", "CASE WHEN pri < 3 THEN NULL ELSE k + pri - 3 END AS ref_kodinsz"
    ),
    "sp_lspv": """
  SELECT c_custkey + CASE WHEN c_mktsegment = 'MACHINERY' THEN 1000000000 ELSE 0 END AS ssylka_fl,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'и' ELSE 'п' END AS status_pen,
         CASE WHEN c_acctbal < 0 THEN NULL
              ELSE DATE '1995-01-01' + CAST(c_custkey % 2000 AS INT) END AS nach_vypl_pen,
         CAST(NULL AS DATE) AS data_zakr
  FROM   {customer}""",
    "vypl_pen": f"""
  SELECT o.c AS ssylka_fl, last_day(l.d) + 10 AS data_op, l.d AS data_nachisl, l.n AS tip_vypl,
         CASE WHEN l.disc = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE l.price END AS summa, l.q AS oplach_dni,
         {_CONTRIBUTOR.format("o.c")} AS nom_vkl, o.c AS nom_ips, l.s AS ssylka_doc
  FROM   {{line}} l JOIN {{ord}} o ON o.k = l.k""",
    "sp_invalid": """
  SELECT c_custkey AS ssylka_fl, CAST(1 + c_custkey % 3 AS INT) AS grup_inv,
         DATE '1996-01-01' + CAST(c_custkey % 900 AS INT) AS data_zakl_vtek,
         'Z' || CAST(c_custkey AS STRING) AS nom_zakl_vtek, CAST(c_acctbal AS DECIMAL(12,2)) AS summa_ips,
         CAST(0 AS DECIMAL(12,2)) AS summa_rsf, CAST(0 AS DECIMAL(12,2)) AS summa_ips_u,
         CAST(0 AS DECIMAL(12,2)) AS summa_ips_f, DATE '1998-01-01' + CAST(c_custkey % 700 AS INT) AS pereosv,
         DATE '1996-02-01' + CAST(c_custkey % 800 AS INT) AS data_pens
  FROM   {customer} WHERE c_acctbal < 0""",
    "sp_invalid_arh": """
  SELECT ssylka_fl, grup_inv, dat_zakl_vtek, nom_zakl_vtek, summa_ips, summa_rsf, summa_ips_u, summa_ips_f,
         lpad(CAST(day(a) AS STRING), 2, '0') || '.' || lpad(CAST(month(a) AS STRING), 2, '0') || '.'
           || CAST(year(a) AS STRING) AS pereosv,
         lpad(CAST(day(b) AS STRING), 2, '0') || '.' || lpad(CAST(month(b) AS STRING), 2, '0') || '.'
           || CAST(year(b) AS STRING) AS data_pens
  FROM  (SELECT c_custkey AS ssylka_fl, 2 AS grup_inv,
                DATE '1996-01-01' + CAST(c_custkey % 900 AS INT) AS dat_zakl_vtek, 'ZA' AS nom_zakl_vtek,
                CAST(c_acctbal AS DECIMAL(12,2)) AS summa_ips, CAST(0 AS DECIMAL(12,2)) AS summa_rsf,
                CAST(0 AS DECIMAL(12,2)) AS summa_ips_u, CAST(0 AS DECIMAL(12,2)) AS summa_ips_f,
                DATE '1997-01-01' + CAST(c_custkey % 700 AS INT) AS a,
                DATE '1995-02-01' + CAST(c_custkey % 800 AS INT) AS b
         FROM   {customer} WHERE c_acctbal > 9000) t""",
    "sp_ogr_pv": _RESTRICTION.format(where="st <> 'F'"),
    "sp_ogr_pv_arh": _RESTRICTION.format(where="st = 'F'"),
    "reer_doc_ngpf": """
  SELECT ssylka, ssylka + 22000000 AS ref_kodinsz, pri AS tip_doc, data_doc, 'D' || CAST(pri AS STRING) AS kem_podpis,
         CASE WHEN overridden THEN 'Закрыть ИПС по выплате пенсий'
              WHEN kind = 0 THEN 'Закрыть ИПС для выплаты пенсии за ' || mon || ' ' || yyyy || ' г.'
              WHEN kind = 1 THEN 'Закрыть ИПС, выплата пенсий, первая половина, ' || mon || ' ' || yyyy
              WHEN kind = 2 THEN 'Закрыть ИПС: втор.пол. ' || mon || ' ' || yyyy || ', выпл. пенсии'
              WHEN kind = 3 THEN 'Закрыть ИПС и выплатить пенсию, год ' || yyyy
              WHEN kind = 4 THEN 'Открыть ИПС для выплаты пенсии за ' || mon || ' ' || yyyy
              ELSE 'Закрыть ИПС для выплаты пенсии за ' || mon END AS kr_soderg,
         CAST(NULL AS BIGINT) AS kod_insz
  FROM  (SELECT k AS ssylka, pri, CAST(k % 6 AS INT) AS kind, CAST(year(d) AS STRING) AS yyyy,
                k IN (531, 414, 359, 313, 173, 164, 103) AS overridden,
                CASE WHEN k IN (531, 414, 359, 313, 173, 164, 103) THEN DATE '1996-06-15'
                     WHEN k % 17 = 0 AND k % 6 < 3 THEN NULL ELSE d END AS data_doc,
                CASE month(d) WHEN 1 THEN 'январь' WHEN 2 THEN 'февраль' WHEN 3 THEN 'март' WHEN 4 THEN 'апрель'
                     WHEN 5 THEN 'май' WHEN 6 THEN 'июнь' WHEN 7 THEN 'июль' WHEN 8 THEN 'август'
                     WHEN 9 THEN 'сентябрь' WHEN 10 THEN 'октябрь' WHEN 11 THEN 'ноябрь'
                     ELSE 'декабрь' END AS mon
         FROM {ord}) t""",
    "izmeneniya": """
  SELECT event_id AS nom_izm,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4
                         ELSE 5 END AS kod_izm,
         CAST(event_id % 7 AS INT) AS kod_doc, CAST(event_id % 5 AS INT) AS kod_oper,
         CAST(ts AS DATE) AS data_otrab, CAST(ts AS DATE) + 1 AS data_zanes, 1 AS kod_sost
  FROM   {events}""",
    "izm_key_val": """
  SELECT event_id AS nom_izm, CAST(1 + event_id % 2 AS INT) AS nom_trans, CAST(1 + event_id % 3 AS INT) AS fld_nom,
         CAST(user_id AS STRING) AS val
  FROM   {events}""",
    "izm_spr_soderg": """
  SELECT * FROM (VALUES (1, 'просмотр'), (2, 'выбор'), (3, 'покупка'), (4, 'регистрация')) AS v(kod_izm, soderg)""",
    "sp_izm_pd": """
  SELECT c AS ssylka_fl, k AS nom_izm, d AS data_izm, price AS summa_izm, pri AS otpechatano, k AS ssylka_doc,
         pri AS mod_pism, d + 1 AS data_pism, st AS sagenev, d + 2 AS dat_zanes, 0 AS no_otpr,
         CAST(NULL AS STRING) AS coment, k AS id, pri AS sostoyanie, 1 AS forma
  FROM   {ord}""",
    "sp_ips": f"""
  SELECT c_custkey AS ssylka_fl, {_CONTRIBUTOR.format("c_custkey")} AS nom_vkl, c_custkey AS nom_ips,
         c_nationkey AS tip_lits
  FROM   {{customer}}""",
    "dv_sr_ips": f"""
  SELECT {_CONTRIBUTOR.format("o.c")} AS nom_vkl, o.c AS nom_ips, l.d AS data_op, l.price AS summa,
         CAST(l.s % 4 AS INT) AS shifr_schet, l.n % 2 AS sub_shifr_schet
  FROM   {{line}} l JOIN {{ord}} o ON o.k = l.k""",
    "kod_shifr_schet": """
  SELECT * FROM (VALUES (0, 0, 1), (0, 1, -1), (1, 0, 1), (1, 1, -1), (2, 0, 1), (2, 1, 1), (3, 0, -1))
           AS v(shifr_schet, sub_shifr_schet, ips)""",
    # target
    "accounts": """
  SELECT 7000000000 + c_custkey AS id, c_nationkey % 9 AS fk_scheme, 'A' || CAST(c_custkey AS STRING) AS acct_number,
         c_name AS title, CAST(c_custkey % 6 AS INT) AS fk_acct_type
  FROM   {customer}""",
    "accounts_balance": """
  SELECT 7000000000 + c_custkey + CASE WHEN c_acctbal > 0 THEN 0 ELSE 900000000 END AS fk_account, DATE '1998-08-01' AS transfer_date,
         CAST(c_acctbal AS DECIMAL(10,2)) AS amount, DATE '1998-09-01' AS update_date
  FROM   {customer}""",
    "contracts": """
  SELECT k AS fk_document, k AS cntr_number, 6000000000 + k AS fk_account, c % 25 AS fk_company,
         CAST(k % 9 AS INT) AS fk_scheme, c AS fk_contragent, CASE WHEN pri = 4 THEN 5 ELSE 6 END AS fk_cntr_type
  FROM   {ord}
  UNION ALL
  SELECT 9000000000 + c_custkey, c_custkey, 7000000000 + c_custkey, c_custkey % 25,
         1 + c_nationkey % 8, c_custkey, 1
  FROM   {customer}""",
    "pension_agreements": """
  SELECT k AS fk_contract, 9000000000 + c AS fk_base_contract, CASE WHEN st = 'O' THEN 1 ELSE 2 END AS state,
         CASE pri WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 6 ELSE 12 END AS period_code,
         CASE WHEN pri = 5 THEN 1 ELSE 0 END AS isarhv, k + 5 AS fk_pay_detail, d AS effective_date,
         CASE WHEN pri = 2 THEN d + 700 ELSE NULL END AS expiration_date, price AS amount, d - 20 AS creation_date,
         d - 1 AS last_update,
         CASE WHEN k % 50 = 0 THEN d ELSE make_date(year(d), month(d), 1) END AS date_pension_age
  FROM   {ord}""",
    "transform_contragents": """
  SELECT 9000000000 + c_custkey AS fk_contract, c_custkey AS ssylka_fl, c_custkey + 1 AS ssylka_ts
  FROM   {customer}""",
    "pension_agreement_addendums": f"""
  SELECT {_LINE_ID} AS id, k AS fk_pension_agreement, s AS fk_provacct, CAST(n - 1 AS BIGINT) AS serialno,
         CASE WHEN tax = 0.08 THEN NULL ELSE price END AS amount,
         DATE '1995-01-01' + CAST(k % 2000 AS INT) + (n - 1) * 17 + q % 13
           - CASE WHEN rf = 'A' THEN 40 ELSE 0 END AS alt_date_begin,
         CAST(NULL AS DATE) AS alt_date_end, CAST(CASE WHEN rf = 'R' THEN n ELSE 0 END AS BIGINT) AS canceled,
         d AS creation_date
  FROM   {{line}}""",
    "pension_agreement_periods": """
  SELECT CASE WHEN pri = 1 THEN 5000000000 ELSE 0 END + k AS fk_pension_agreement,
         make_date(year(d), month(d), 1) AS calc_date,
         make_date(year(d), month(d), 1) AS check_date, CAST(NULL AS @TS) AS creation_date,
         d AS pa_effective_date, CASE WHEN pri = 3 THEN 'Y' ELSE NULL END AS is_disabled_pa
  FROM   {ord}""",
    "pay_restrictions": """
  SELECT k AS id, k AS fk_doc_with_acct, d - 30 AS effective_date,
         CASE WHEN k % 3 = 0 THEN NULL ELSE d + CAST(k % 300 AS INT) END AS expiration_date,
         CAST(CASE WHEN pri = 4 THEN 1 ELSE NULL END AS BIGINT) AS fk_document_cancel
  FROM   {ord}""",
    "pay_orders": f"""
  SELECT k AS fk_document, d AS payment_period, d AS operation_date, '00001111' AS payment_freqmask,
         d AS scheduled_date, d - 3 AS calculation_date, CAST(k % 5 AS INT) AS fk_pay_order_type,
         0 AS export_err_count
  FROM   {{ord}}
  UNION ALL
  SELECT {_ORDER_OF_OP.format("op")}, make_date(year(op), month(op), 1), op, '00001111', op, op - 3, 5, 0
  FROM  (SELECT DISTINCT {_OP} AS op FROM {{line}}) t""",
    "pay_order_filters": """
  SELECT k AS id, k + CASE WHEN st = 'F' THEN 0 ELSE 900000000 END AS fk_pay_order,
         CASE WHEN pri = 5 THEN 'OTHER' WHEN k % 70 = 0 THEN 'CONTRACT AND MORE' ELSE 'CONTRACT' END AS filter_code,
         c AS filter_value
  FROM   {ord}""",
    # Filters of the accrual orders by operation date.
    "order_filters": f"""
  SELECT DISTINCT k AS id, {_ORDER_OF_OP.format(_OP)} AS fk_pay_order FROM {{line}}""",
    "filter_requests": """
  SELECT k AS fk_pay_order, 'CONTRACT' AS filter_code, c AS filter_value FROM {ord}""",
    "assignments": _ASSIGNMENT.format(amount="price", where=""),
    # A second run: some accruals are missing, some differ by a cent.
    "assignments_new": _ASSIGNMENT.format(
        amount="price + CASE WHEN tax > 0.075 THEN 0.01 ELSE 0.00 END",
        where="\n  WHERE  disc < 0.095",
    ),
    "debt_withholdings": f"""
  SELECT {_LINE_ID} + CASE WHEN disc > 0.09 THEN 1 ELSE 0 END AS fk_debt_assignment FROM {{line}}""",
    "transform_po": f"""
  SELECT {_ORDER_OF_OP.format("op")} - 8000000000 AS ssylka_doc, 1 AS flag_usage, 1 AS rn, 2 AS max_half_month,
         op AS operation_date, make_date(year(op), month(op), 1) AS payment_period, 1 AS half_month,
         {_ORDER_OF_OP.format("op")} AS fk_document
  FROM  (SELECT DISTINCT {_OP} AS op FROM {{line}}) t""",
    "transform_pa_assignments": f"""
  SELECT op AS date_op, s AS ssylka_doc, {_ORDER_OF_OP.format("op")} AS fk_pay_order, 'IMP' AS import_id,
         CASE s % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'W' ELSE 'C' END AS state, CAST(op - 5 AS @TS) AS creation_date,
         CASE s % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(op AS @TS) + INTERVAL '7' HOUR
                    ELSE CAST(op AS @TS) + INTERVAL '100' SECOND END AS last_update_date
  FROM  (SELECT DISTINCT {_OP} AS op, s FROM {{line}}) t""",
    # Control rows as they arrive, before the unique rule is applied.
    "control_batch": f"""
  SELECT {_OP} AS date_op, s AS ssylka_doc, {_ORDER_OF_OP.format(_OP)} AS fk_pay_order,
         CASE WHEN disc = 0.05 THEN NULL WHEN disc = 0.06 AND n = 2 THEN 'IMPORT 1998-09-01' ELSE 'IMP' END AS import_id,
         CASE WHEN n = 3 THEN 'NEW' ELSE NULL END AS state, n AS line_number, {_LINE_ID} AS line_id
  FROM   {{line}}""",
    # Documents as they arrive: line items of one order compete for two keys, in short chains.
    "document_batch": f"""
  SELECT k * 10 + n % 3 AS ssylka_doc, k * 10 + (n * n + q) % 4 AS fk_document, CAST(1 AS INT) AS flag_usage,
         CAST(n AS BIGINT) AS rn, CAST(2 AS INT) AS max_half_month, CAST(CASE WHEN disc = 0.05 THEN 10 ELSE 1 END AS INT) AS half_month,
         k, {_LINE_ID} AS line_id
  FROM   {{line}}""",
    "contragent_corrections": """
  SELECT fk_contract, ssylka_fl + 500000 AS ssylka_fl FROM {transform_contragents} WHERE fk_contract % 9 = 0""",
    "corrections": """
  SELECT ssylka, ref_kodinsz + 1 AS ref_kodinsz, ref_kodinsz + 1 AS kod_insz FROM {reer_doc_ngpf} WHERE tip_doc = 1""",
}

# Texts put together from many pieces are written once, as the table they stand for is; otherwise every use of a text
# would put it together again.
COMPOSED = {"reer_doc_ngpf"}

_REFERENCE = re.compile(r"\{([a-z]\w*)\}")


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(_REFERENCE.findall(sql)))


class Model:
    """The pension tables of one data folder as attributes, each built once and lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._built = spark, folder, {}

    def with_table(self, name: str, df: DataFrame) -> Model:
        """The same model with one benchmark table replaced."""
        other = type(self)(self.spark, self.folder)
        other._built[name] = df
        return other

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            if name in BENCHMARK_TABLES:
                self._built[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in MAPPINGS:
                sql = MAPPINGS[name].replace("@TS", "TIMESTAMP_NTZ")
                parts = {r: getattr(self, r) for r in references(sql)}
                built = self.spark.sql(sql, **parts)
                self._built[name] = stage(built) if name in COMPOSED else built
            else:
                raise AttributeError(name)
        return self._built[name]
