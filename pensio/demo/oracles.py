"""The registered queries once more, as plain SQL for an independent engine (DuckDB) over the same tables.

Written straight from the meaning of each query with whole-table windows and correlated subqueries, not from the
Spark plans. ``{name}`` refers to another fragment, a table mapping or a benchmark table.
"""

from __future__ import annotations

from pensio.demo.catalog import LISTED_VERSIONS
from pensio.demo.mapping import BENCHMARK_TABLES, MAPPINGS, references
from pensio.plans.contracts import CONTRACT_EXCLUSIONS

_OP_DATE = "DATE '1998-09-10'"

VIEWS = {
    "legacy_contracts": """
  SELECT 'SP_PEN_DOG' AS source_table, p.*, CAST(NULL AS TIMESTAMP) AS data_arh, l.status_pen,
         coalesce(l.nach_vypl_pen, p.data_nach_vypl) AS lspv_nach_vypl_pen,
         CAST(p.data AS TIMESTAMP) AS cntr_print_date, coalesce(p.data, p.data_nach_vypl) AS cntr_date
  FROM   {sp_pen_dog} p LEFT JOIN {sp_lspv} l ON l.ssylka_fl = p.ssylka
  UNION ALL BY NAME
  SELECT 'SP_PEN_DOG_ARH' AS source_table, a.*, 'A' AS status_pen, a.data_nach_vypl AS lspv_nach_vypl_pen,
         a.data_arh AS cntr_print_date, coalesce(CAST(a.data_arh AS DATE), a.data_nach_vypl) AS cntr_date
  FROM   {sp_pen_dog_arh} a
  WHERE  NOT EXISTS (SELECT 1 FROM {contract_exclusions} e
                     WHERE e.ssylka_fl = a.ssylka AND (a.data_arh IS NULL OR e.data_arh = a.data_arh))""",
    "contracts_v": """
  SELECT row_number() OVER starts AS dog_rn, count(*) OVER (PARTITION BY ssylka) AS dog_cnt,
         * EXCLUDE (data_okon_vypl), lead(data_nach_vypl) OVER starts - 1 AS data_okon_vypl,
         data_okon_vypl AS pd_data_okon_vypl
  FROM   {legacy_contracts} WHERE nom_vkl <> 1001
  WINDOW starts AS (PARTITION BY ssylka ORDER BY data_nach_vypl NULLS LAST, ref_kodinsz, source_table)""",
    "periods_v": """
  SELECT dog_rn, dog_cnt, ssylka, source_table, nom_vkl, nom_ips, fio, status_pen,
         if(dog_rn = 1, DATE '0001-01-01', CAST(date_trunc('month', data_nach_vypl) AS DATE)) AS from_date,
         if(dog_rn = dog_cnt, DATE '9999-12-31',
            CAST(date_trunc('month', data_okon_vypl) AS DATE) - 1) AS to_date,
         data_nach_vypl, data_okon_vypl, lspv_nach_vypl_pen, pd_data_okon_vypl, data_otkr, type_dog, shema_dog,
         razm_pen, data_perevoda_5_cx, ref_kodinsz, data_arh, data
  FROM   {contracts_v}""",
    "payments_v": """
  SELECT c.status_pen, v.ssylka_fl, v.data_op, v.data_nachisl, v.tip_vypl, v.summa, v.oplach_dni, v.nom_vkl, v.nom_ips,
         v.ssylka_doc, c.data_nach_vypl, c.data_okon_vypl, c.lspv_nach_vypl_pen, c.pd_data_okon_vypl, c.ref_kodinsz,
         c.shema_dog, c.data_perevoda_5_cx, c.source_table, c.from_date, c.to_date, c.data
  FROM   {vypl_pen} v JOIN {periods_v} c
         ON c.ssylka = v.ssylka_fl AND v.data_nachisl >= c.from_date AND v.data_nachisl <= c.to_date""",
    "invalid_v": """
  SELECT 'SP_INVALID' AS tbl, * FROM {sp_invalid}
  UNION ALL BY NAME
  SELECT 'SP_INVALID_ARH' AS tbl, * EXCLUDE (dat_zakl_vtek) REPLACE (
           CAST(strptime(pereosv, '%d.%m.%Y') AS DATE) AS pereosv,
           CAST(strptime(data_pens, '%d.%m.%Y') AS DATE) AS data_pens),
         dat_zakl_vtek AS data_zakl_vtek
  FROM   {sp_invalid_arh} WHERE ssylka_fl NOT IN (311413, 218130, 786929, 188380, 491724)""",
    "restrictions_v": """
  SELECT 'SP_OGR_PV' AS source_table, r.* FROM {sp_ogr_pv} r
  WHERE  r.kod_ogr_pv < 100 AND r.nom_vkl <> 1001
  AND    CASE WHEN r.kod_ogr_pv = 3
              THEN r.ssylka_fl IN (SELECT ssylka_fl FROM {sp_lspv} WHERE status_pen = 'и'
                                   UNION SELECT ssylka_fl FROM {invalid_v})
              ELSE TRUE END
  UNION ALL
  SELECT 'SP_OGR_PV_ARH', r.* FROM {sp_ogr_pv_arh} r WHERE r.kod_ogr_pv < 100 AND r.nom_vkl <> 1001""",
    "rev_v": """
  SELECT * EXCLUDE (following)
           REPLACE (if(kod_ogr_pv = 3, okon_deistv + 1, nach_deistv) AS nach_deistv,
                    if(kod_ogr_pv = 3, following - 1, okon_deistv) AS okon_deistv),
         nach_deistv AS real_nach_deistv, okon_deistv AS real_okon_deistv
  FROM  (SELECT *, lead(nach_deistv) OVER (PARTITION BY ssylka_fl, kod_ogr_pv
                                           ORDER BY nach_deistv NULLS LAST, id, source_table) AS following
         FROM {restrictions_v}) w""",
    "imp_v": """
  SELECT source_table, nom_vkl, nom_ips, kod_ogr_pv, nach_deistv,
         if(okon_deistv < nach_deistv, NULL, okon_deistv) AS okon_deistv, primech, ssylka_fl, kod_insz, ssylka_td,
         rid_td, id, real_nach_deistv, real_okon_deistv, data_nach_vypl, status_pen,
         CASE WHEN source_table = 'SP_OGR_PV_ARH' OR okon_deistv <= nach_deistv OR paid_in_gap THEN 'Y'
              ELSE 'N' END AS is_cancel,
         count(*) OVER (PARTITION BY ssylka_fl, data_nach_vypl, nach_deistv) AS cnt,
         row_number() OVER (PARTITION BY ssylka_fl, data_nach_vypl, nach_deistv
                            ORDER BY if(source_table = 'SP_OGR_PV', 2, 1),
                                     coalesce(okon_deistv, DATE '9999-12-31') DESC, kod_ogr_pv, real_nach_deistv,
                                     id, ref_kodinsz) AS rn
  FROM  (SELECT r.*, c.data_nach_vypl, c.status_pen, c.ref_kodinsz,
                r.kod_ogr_pv = 3 AND r.okon_deistv IS NULL
                AND EXISTS (SELECT 1 FROM {vypl_pen} v
                            WHERE v.ssylka_fl = r.ssylka_fl AND v.data_nachisl >= r.nach_deistv
                            AND   v.data_nachisl <= c.to_date) AS paid_in_gap
         FROM   {rev_v} r JOIN {periods_v} c ON c.ssylka = r.ssylka_fl
         WHERE  r.real_nach_deistv >= if(c.dog_rn = 1, c.from_date, c.data_nach_vypl)
         AND    r.real_nach_deistv <= if(c.dog_rn = c.dog_cnt, c.to_date,
                                         coalesce(c.data_okon_vypl, r.real_nach_deistv))
         AND    r.nach_deistv < DATE '2050-01-01'
         AND   (r.kod_ogr_pv <> 3 OR r.real_okon_deistv IS NOT NULL OR r.source_table = 'SP_OGR_PV_ARH')) m""",
    "imp_fixed_v": """
  SELECT source_table, nom_vkl, nom_ips, kod_ogr_pv, nach_deistv,
         if(okon_deistv < nach_deistv, NULL, okon_deistv) AS okon_deistv, primech, ssylka_fl, kod_insz, ssylka_td,
         rid_td, id, real_nach_deistv, real_okon_deistv, data_nach_vypl, status_pen,
         CASE WHEN source_table = 'SP_OGR_PV_ARH' OR okon_deistv <= nach_deistv OR paid_in_gap OR paid_throughout THEN 'Y'
              ELSE 'N' END AS is_cancel,
         count(*) OVER (PARTITION BY ssylka_fl, data_nach_vypl, nach_deistv) AS cnt,
         row_number() OVER (PARTITION BY ssylka_fl, data_nach_vypl, nach_deistv
                            ORDER BY if(source_table = 'SP_OGR_PV', 2, 1),
                                     coalesce(okon_deistv, DATE '9999-12-31') DESC, kod_ogr_pv, real_nach_deistv,
                                     id, ref_kodinsz) AS rn
  FROM  (SELECT r.*, c.data_nach_vypl, c.status_pen, c.ref_kodinsz,
                r.kod_ogr_pv = 3 AND r.okon_deistv IS NULL
                AND EXISTS (SELECT 1 FROM {vypl_pen} v
                            WHERE v.ssylka_fl = r.ssylka_fl AND v.data_nachisl >= r.nach_deistv
                            AND   v.data_nachisl <= c.to_date) AS paid_in_gap,
                r.kod_ogr_pv = 3 AND r.okon_deistv IS NOT NULL AND c.to_date IS NOT NULL
                AND (SELECT count(DISTINCT v.data_nachisl) FROM {vypl_pen} v
                     WHERE v.ssylka_fl = r.ssylka_fl AND v.data_nachisl >= date_trunc('month', r.nach_deistv)
                     AND   v.data_nachisl <= last_day(least(r.okon_deistv, c.to_date)))
                    = date_diff('month', r.nach_deistv, r.okon_deistv) + 1 AS paid_throughout
         FROM   {rev_v} r JOIN {periods_v} c ON c.ssylka = r.ssylka_fl
         WHERE  r.real_nach_deistv >= if(c.dog_rn = 1, c.from_date, c.data_nach_vypl)
         AND    r.real_nach_deistv <= if(c.dog_rn = c.dog_cnt, c.to_date,
                                         coalesce(c.data_okon_vypl, r.real_nach_deistv))
         AND    r.nach_deistv < DATE '2050-01-01'
         AND   (r.kod_ogr_pv <> 3 OR r.real_okon_deistv IS NOT NULL OR r.source_table = 'SP_OGR_PV_ARH')) m""",
    "moves_v": """
  SELECT i.ssylka_fl AS ssylka, m.data_op AS date_op, CAST(k.ips * m.summa AS DECIMAL(18,2)) AS amount, m.shifr_schet,
         m.sub_shifr_schet, i.tip_lits, i.nom_vkl AS ips_nom_vkl, i.nom_ips AS ips_nom_ips
  FROM   {dv_sr_ips} m JOIN {kod_shifr_schet} k USING (shifr_schet, sub_shifr_schet)
         JOIN {sp_ips} i USING (nom_vkl, nom_ips)""",
    "balances_v": """
  SELECT c.ref_kodinsz, m.ssylka, c.data_nach_vypl, m.date_op, m.amount, c.data_perevoda_5_cx, m.shifr_schet,
         m.sub_shifr_schet, c.nom_vkl, c.nom_ips, m.tip_lits, m.ips_nom_vkl, m.ips_nom_ips
  FROM   {sp_pen_dog} c JOIN {moves_v} m USING (ssylka)
  WHERE  c.shema_dog IN (2, 3, 4, 5, 8) AND c.nom_vkl <> 1001""",
    "changes_v": """
  SELECT * REPLACE (if(id IN (100, 2060058), DATE '2006-11-28', data_izm) AS data_izm) FROM {sp_izm_pd}""",
    "segments_v": """
  SELECT id, CAST(date_trunc('month', alt_date_begin) AS DATE) AS from_month, alt_date_begin AS from_date,
         coalesce(lead(alt_date_begin) OVER serials - 1, DATE '4713-01-01') AS end_date, fk_pension_agreement,
         fk_provacct, serialno,
         row_number() OVER (PARTITION BY fk_pension_agreement, date_trunc('month', alt_date_begin)
                            ORDER BY serialno, id) AS month_serialno,
         lag(amount) OVER serials AS amount_prev, amount, alt_date_begin, alt_date_end,
         last_day(alt_date_begin) AS last_day_from_month
  FROM   {pension_agreement_addendums} WHERE canceled = 0
  WINDOW serials AS (PARTITION BY fk_pension_agreement ORDER BY serialno, id)""",
    "months_v": """
  SELECT fk_pension_agreement, from_date, end_date,
         CAST(CAST(sign(n) AS BIGINT) * ((2 * abs(n) + dim) // (2 * dim)) AS DECIMAL(18,0)) * 0.01 AS first_amount,
         amount, fk_provacct
  FROM  (SELECT fk_pension_agreement, from_month AS from_date, max(amount) AS amount,
                max(greatest(if(end_date = last_day(end_date), end_date,
                                CAST(date_trunc('month', end_date) AS DATE) - 1),
                             last_day_from_month)) AS end_date,
                CAST(sum(if(month_serialno = 1 AND from_month < alt_date_begin AND amount_prev IS NOT NULL,
                            CAST(amount_prev * 100 AS BIGINT) * date_diff('day', from_month, alt_date_begin), 0)
                         + CAST(amount * 100 AS BIGINT)
                           * (date_diff('day', alt_date_begin, least(end_date, last_day_from_month)) + 1)
                        ) AS BIGINT) AS n,
                day(last_day(from_month)) AS dim, arg_max_null(fk_provacct, month_serialno) AS fk_provacct
         FROM   {segments_v} GROUP BY fk_pension_agreement, from_month) g""",
    "agreements_v": """
  SELECT a.fk_base_contract, a.fk_contract, own.cntr_number, a.state, a.period_code, a.isarhv,
         base.fk_account AS fk_debit, own.fk_account AS fk_credit, a.fk_pay_detail, own.fk_company, own.fk_scheme,
         own.fk_contragent, a.effective_date, a.expiration_date, a.amount AS pa_amount,
         ifnull(a.expiration_date, DATE '9999-12-31') AS last_pay_date, a.creation_date, a.last_update,
         base.fk_cntr_type AS fk_base_cntr_type, base.fk_scheme AS fk_base_scheme, a.date_pension_age
  FROM   {pension_agreements} a JOIN {contracts} own ON own.fk_document = a.fk_contract
         JOIN {contracts} base ON base.fk_document = a.fk_base_contract
  WHERE  own.fk_cntr_type = 6 AND own.fk_scheme IN (1, 2, 3, 4, 5, 6, 8) AND base.fk_scheme IN (1, 2, 3, 4, 5, 6, 8)""",
    "active_v": """
  SELECT * EXCLUDE (cntr_number, isarhv, fk_pay_detail, last_update, fk_base_cntr_type, fk_base_scheme)
  FROM   {agreements_v} WHERE state = 1 AND isarhv = 0""",
    "agreement_periods_v": """
  SELECT p.* EXCLUDE (creation_date), a.* EXCLUDE (fk_contract)
  FROM   {pension_agreement_periods} p JOIN {active_v} a ON a.fk_contract = p.fk_pension_agreement""",
    "paid": f"""
  SELECT a.fk_contract, v.data_nachisl, v.ssylka_fl, v.data_op, v.tip_vypl, sum(v.summa) AS amount
  FROM   {{payments_v}} v JOIN {{transform_contragents}} t ON t.ssylka_fl = v.ssylka_fl
         JOIN {{agreements_v}} a ON a.fk_base_contract = t.fk_contract AND a.effective_date = v.data_nach_vypl
  WHERE  v.data_op = {_OP_DATE} AND v.summa <> 0
  GROUP BY ALL""",
    "reopened": f"""
  SELECT a.* REPLACE (if(a.canceled > 0 AND EXISTS (
           SELECT 1 FROM {{pension_agreement_addendums}} b
           WHERE  b.fk_pension_agreement = a.fk_pension_agreement AND b.serialno = a.canceled
           AND    b.creation_date > {_OP_DATE} - 4
           AND    b.fk_pension_agreement IN (SELECT fk_contract FROM {{paid}})), 0, a.canceled) AS canceled)
  FROM   {{pension_agreement_addendums}} a""",
    "recorded": "SELECT ssylka_fl FROM {invalid_v}",
    "quarterly": "SELECT fk_contract FROM {pension_agreements} WHERE period_code = 3",
    "order_dates": """
  SELECT d.operation_date, e.fk_document AS existing, row_number() OVER (PARTITION BY e.fk_document IS NULL
                                                                         ORDER BY d.operation_date) AS i
  FROM  (SELECT DISTINCT operation_date FROM {pay_orders}) d
         LEFT JOIN (SELECT operation_date, min(fk_document) AS fk_document FROM {pay_orders}
                    WHERE fk_pay_order_type = 5 GROUP BY operation_date) e USING (operation_date)""",
}

_CONTRACT_DATES = (
    "data_arh data_otkr data_nach_vypl data_okon_vypl lspv_nach_vypl_pen pd_data_okon_vypl data_dog data data_uvoln "
    "data_perevoda_5_cx cntr_print_date cntr_date"
)
_PERIOD_DATES = (
    "from_date to_date data_nach_vypl data_okon_vypl lspv_nach_vypl_pen pd_data_okon_vypl data_otkr "
    "data_perevoda_5_cx data_arh data"
)
_PAYMENT_DATES = (
    "data_op data_nachisl data_nach_vypl data_okon_vypl lspv_nach_vypl_pen pd_data_okon_vypl data_perevoda_5_cx "
    "from_date to_date data"
)
_ASSIGNMENT_DATES = "paydate serv_date creation_date"
_INVALID_DATES = "data_zakl_vtek pereosv data_pens"
_AGREEMENT_DATES = "effective_date expiration_date last_pay_date creation_date last_update date_pension_age"
_ACTIVE_DATES = "effective_date expiration_date last_pay_date creation_date date_pension_age"
_WINDOW_DATES = f"calc_date check_date pa_effective_date {_ACTIVE_DATES}"
_TABLE_AGREEMENT_DATES = "effective_date expiration_date creation_date last_update date_pension_age"
_ADDENDUM_DATES = "alt_date_begin alt_date_end creation_date"
_BALANCE_DATES = "data_nach_vypl date_op data_perevoda_5_cx"
_CHANGE_DATES = "data_izm data_pism dat_zanes"
_SOURCE_CONTRACT_DATES = (
    "data_otkr data_nach_vypl data_okon_vypl data_dog data data_uvoln data_perevoda_5_cx"
)

_MONTH_NUMBER = "list_position(['январь','февраль','март','апрель','май','июнь','июль','август','сентябрь','октябрь','ноябрь','декабрь'], {})"

_LISTED = ", ".join(f"({k}, '{t}')" for k, t in (*CONTRACT_EXCLUSIONS, *LISTED_VERSIONS))

# Query -> (SQL, date columns rendered as text).
ORACLES: dict[str, tuple[str, str]] = {
    "snapshot_run": (
        f"""SELECT a.* FROM {{assignments}} a JOIN {{pay_orders}} o ON o.fk_document = a.fk_doc_with_action
            WHERE o.operation_date = {_OP_DATE} AND o.fk_pay_order_type = 5""",
        _ASSIGNMENT_DATES,
    ),
    "append_with_rejects": (
        """SELECT if(e IS NULL, 'accepted', 'rejected') AS outcome, 
                  CASE e WHEN 'paydays under 50' THEN 2290 WHEN 'parent of (fk_doc_with_acct)' THEN 2291 END AS error_number,
                  e AS error_message, if(e IS NULL, NULL, 'accrual') AS error_tag,
                  CAST(1000 + i AS VARCHAR) AS id, CAST(given AS VARCHAR) AS given, CAST(amount AS VARCHAR) AS amount,
                  '0.00' AS paytax, '0' AS iscancel, CAST(coalesce(direction, 1) AS VARCHAR) AS direction,
                  '1998-09-01 12:00:00' AS creation_date
           FROM  (SELECT a.id AS given, a.amount, a.direction, row_number() OVER (ORDER BY a.id) AS i,
                         CASE WHEN a.paydays >= 50 THEN 'paydays under 50'
                              WHEN NOT EXISTS (SELECT 1 FROM {agreements_v} v WHERE v.fk_contract = a.fk_doc_with_acct)
                              THEN 'parent of (fk_doc_with_acct)' END AS e
                  FROM {assignments} a) j""",
        "",
    ),
    "append_unique": (
        """SELECT if(e IS NULL, 'accepted', 'rejected') AS outcome, e AS error_number, CAST(line_id AS VARCHAR) AS line_id
           FROM  (SELECT line_id,
                         CASE WHEN import_id IS NULL THEN 1400
                              WHEN length(import_id) > 14 OR length(state) > 1 THEN 12899
                              WHEN EXISTS (SELECT 1 FROM {transform_pa_assignments} t
                                           WHERE t.state = 'W' AND t.date_op = b.date_op AND t.ssylka_doc = b.ssylka_doc)
                              THEN 1
                              WHEN row_number() OVER (PARTITION BY date_op, ssylka_doc, import_id IS NULL
                                                           OR length(import_id) > 14 OR length(state) > 1
                                                      ORDER BY line_id) > 1 THEN 1 END AS e
                  FROM {control_batch} b) j""",
        "",
    ),
    "append_stream": (
        """SELECT if(e IS NULL, 'accepted', 'rejected') AS outcome, e AS error_number, CAST(line_id AS VARCHAR) AS line_id,
                  CAST(99 + i AS VARCHAR) AS given
           FROM  (SELECT line_id, row_number() OVER (ORDER BY part, line_id) AS i,
                         CASE WHEN import_id IS NULL THEN 1400
                              WHEN length(import_id) > 14 OR length(state) > 1 THEN 12899
                              WHEN row_number() OVER (PARTITION BY date_op, ssylka_doc, import_id IS NULL
                                                           OR length(import_id) > 14 OR length(state) > 1
                                                      ORDER BY part, line_id) > 1 THEN 1 END AS e
                  FROM (SELECT *, line_number % 3 AS part FROM {control_batch}) b) j""",
        "",
    ),
    "append_two_keys": (
        """WITH RECURSIVE b AS (SELECT k, line_id, ssylka_doc, fk_document, half_month > 9 AS bad,
                                       row_number() OVER (PARTITION BY k ORDER BY line_id) AS i FROM {document_batch}),
                r AS (SELECT k, i, line_id, CASE WHEN bad THEN 1438 END AS e, if(bad, [], [ssylka_doc]) AS s,
                             if(bad, [], [fk_document]) AS f FROM b WHERE i = 1
                      UNION ALL
                      SELECT b.k, b.i, b.line_id, CASE WHEN bad THEN 1438 WHEN taken THEN 1 END,
                             if(bad OR taken, s, list_append(s, b.ssylka_doc)),
                             if(bad OR taken, f, list_append(f, b.fk_document))
                      FROM  (SELECT b.*, r.s, r.f, list_contains(r.s, b.ssylka_doc) OR list_contains(r.f, b.fk_document) AS taken
                             FROM r JOIN b ON b.k = r.k AND b.i = r.i + 1) b)
           SELECT if(e IS NULL, 'accepted', 'rejected') AS outcome, e AS error_number, CAST(line_id AS VARCHAR) AS line_id
           FROM r""",
        "",
    ),
    "scan_table": ("SELECT * FROM {pension_agreements}", _TABLE_AGREEMENT_DATES),
    "check_constraints": (
        """SELECT 'pay_order_filters' AS tbl, 'filter_code is COMPANY or CONTRACT' AS rule, CAST(id AS VARCHAR) AS row_key
           FROM {pay_order_filters} WHERE filter_code NOT IN ('COMPANY', 'CONTRACT')
           UNION ALL
           SELECT 'pay_order_filters', 'parent of (fk_pay_order)', CAST(id AS VARCHAR) FROM {pay_order_filters}
           WHERE fk_pay_order NOT IN (SELECT fk_document FROM {pay_orders})
           UNION ALL
           SELECT 'pension_agreement_periods', 'parent of (fk_pension_agreement)', CAST(fk_pension_agreement AS VARCHAR)
           FROM {pension_agreement_periods} WHERE fk_pension_agreement NOT IN (SELECT fk_contract FROM {pension_agreements})
           UNION ALL
           SELECT 'accounts_balance', 'parent of (fk_account)', CAST(fk_account AS VARCHAR) FROM {accounts_balance}
           WHERE fk_account NOT IN (SELECT id FROM {accounts})
           UNION ALL
           SELECT 'pension_agreements', 'date_pension_age is a month start', CAST(fk_contract AS VARCHAR)
           FROM {pension_agreements} WHERE day(date_pension_age) <> 1
           UNION ALL
           SELECT 'debt_withholdings', 'parent of (fk_debt_assignment)', CAST(fk_debt_assignment AS VARCHAR)
           FROM {debt_withholdings} WHERE fk_debt_assignment NOT IN (SELECT id FROM {assignments})
           UNION ALL
           SELECT 'pay_order_filters', 'filter_code is longer than 10', CAST(id AS VARCHAR)
           FROM {pay_order_filters} WHERE length(filter_code) > 10
           UNION ALL
           SELECT 'control_batch', 'import_id is null', CAST(line_id AS VARCHAR)
           FROM {control_batch} WHERE import_id IS NULL
           UNION ALL
           SELECT 'control_batch', 'import_id is longer than 14', CAST(line_id AS VARCHAR)
           FROM {control_batch} WHERE length(import_id) > 14
           UNION ALL
           SELECT 'control_batch', 'state is longer than 1', CAST(line_id AS VARCHAR)
           FROM {control_batch} WHERE length(state) > 1
           UNION ALL
           SELECT 'control_batch', 'unique (date_op, ssylka_doc)', CAST(line_id AS VARCHAR) FROM {control_batch}
           QUALIFY count(*) OVER (PARTITION BY date_op, ssylka_doc) > 1""",
        "",
    ),
    "multi_insert": (
        """SELECT 'documents' AS target, 8100000000 + i - 1 AS id, operation_date AS doc_date,
                  'Тестовое начисление' AS title, CAST(NULL AS DATE) AS payment_period
           FROM {order_dates} WHERE existing IS NULL
           UNION ALL
           SELECT 'pay_orders', 8100000000 + i - 1, operation_date, '00001111',
                  CAST(date_trunc('month', operation_date) AS DATE)
           FROM {order_dates} WHERE existing IS NULL""",
        "doc_date payment_period",
    ),
    "ensure_pay_orders": (
        """SELECT operation_date, coalesce(existing, 8100000000 + i - 1) AS fk_document, existing IS NULL AS is_new
           FROM {order_dates}""",
        "operation_date",
    ),
    "merge_insert_only": (
        """SELECT id, fk_pay_order, filter_code, filter_value FROM {pay_order_filters}
           UNION ALL
           SELECT 20000000000 - 1 + row_number() OVER (ORDER BY r.fk_pay_order), r.fk_pay_order, r.filter_code,
                  r.filter_value
           FROM {filter_requests} r
           WHERE NOT EXISTS (SELECT 1 FROM {pay_order_filters} f WHERE f.fk_pay_order = r.fk_pay_order
                             AND f.filter_code = r.filter_code AND f.filter_value = r.filter_value)""",
        "",
    ),
    "update_where": (
        """SELECT c.* REPLACE (if(fk_cntr_type = 6 AND fk_document IN (SELECT fk_contract FROM {active_v}), 0,
                                  fk_company) AS fk_company) FROM {contracts} c""",
        "",
    ),
    "delete_by_key": (
        "SELECT * FROM {assignments} WHERE fk_doc_with_acct NOT IN (SELECT fk_contract FROM {quarterly})",
        _ASSIGNMENT_DATES,
    ),
    "delete_run": (
        f"""SELECT a.* FROM {{assignments}} a WHERE a.fk_doc_with_action NOT IN (
              SELECT fk_document FROM {{pay_orders}} WHERE operation_date = {_OP_DATE} AND fk_pay_order_type = 5)""",
        _ASSIGNMENT_DATES,
    ),
    "delete_where": (
        "SELECT * FROM {assignments} WHERE direction IS DISTINCT FROM -1",
        _ASSIGNMENT_DATES,
    ),
    "surrogate_key": (
        "SELECT 499 + row_number() OVER (ORDER BY fk_pay_order) AS id, * FROM {filter_requests}",
        "",
    ),
    "const_relation": (
        f"""SELECT a.* FROM {{sp_pen_dog_arh}} a
            WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_LISTED}) AS e(ssylka_fl, data_arh)
                              WHERE e.ssylka_fl = a.ssylka
                              AND (a.data_arh IS NULL OR a.data_arh = CAST(e.data_arh AS TIMESTAMP)))""",
        f"{_SOURCE_CONTRACT_DATES} data_arh",
    ),
    "contract_labels": (
        """SELECT ref_kodinsz, concat(upper(trim(fio)), '/', substr(nom_dog, 2, 4), strftime(data_nach_vypl, '%Y%m%d')) AS label
           FROM {sp_pen_dog}""",
        "",
    ),
    "accounts_sspv": (
        "SELECT fk_scheme, id, acct_number, title FROM {accounts} WHERE fk_acct_type = 4",
        "",
    ),
    "izmeneniya_pd": (
        """SELECT k.val AS ssylka_fl_str, z.*, s.soderg
           FROM {izm_key_val} k JOIN {izmeneniya} z USING (nom_izm) JOIN {izm_spr_soderg} s USING (kod_izm)
           WHERE k.nom_trans = 1 AND k.fld_nom = 1""",
        "data_otrab data_zanes",
    ),
    "registry_pay_orders": (
        f"""SELECT 1 AS flag_usage, row_number() OVER (PARTITION BY yy, mm, half_month ORDER BY den, ssylka) AS rn,
                   max(half_month) OVER (PARTITION BY yy, mm) AS max_half_month, ssylka AS ssylka_doc,
                   ref_kodinsz AS fk_document, make_date(yy, mm, den) AS operation_date,
                   make_date(yy, mm, 1) AS payment_period, half_month, tip_doc, data_doc, kem_podpis, kr_soderg
            FROM  (SELECT *, if(den < 15 OR ssylka IN (47, 164), 1, 2) AS half_month
                   FROM  (SELECT *,
                                 CASE WHEN regexp_matches(kr_soderg, 'первая|перв.пол') THEN 10
                                      WHEN regexp_matches(kr_soderg, 'вторая|втор.пол') THEN 25
                                      ELSE coalesce(day(data_doc), 1) END AS den,
                                 coalesce({_MONTH_NUMBER.format("nullif(regexp_extract(kr_soderg, 'январь|февраль|март|апрель|май|июнь|июль|август|сентябрь|октябрь|ноябрь|декабрь'), '')")},
                                          CASE ssylka WHEN 531 THEN 1 WHEN 414 THEN 12 WHEN 359 THEN 11 WHEN 313 THEN 10
                                               WHEN 173 THEN 9 WHEN 164 THEN 7 WHEN 103 THEN 8 ELSE month(data_doc) END) AS mm,
                                 coalesce(CAST(nullif(regexp_extract(kr_soderg, '\\D(\\d{{4}})(\\D|$)', 1), '') AS INT),
                                          if(ssylka = 531, 1997, 1996)) AS yy
                          FROM   {{reer_doc_ngpf}}
                          WHERE  kr_soderg LIKE 'Закрыть%ИПС%' AND kr_soderg LIKE '%выпл%пенс%'
                          AND    ssylka NOT IN (48, 52, 71, 75)) a) b
            UNION ALL
            SELECT 2, 1, 1, ssylka, ref_kodinsz, data_doc, CAST(date_trunc('month', data_doc) AS DATE), 1, tip_doc,
                   data_doc, kem_podpis, kr_soderg
            FROM   {{reer_doc_ngpf}} WHERE ssylka IN (13906, 38132, 245849, 325969)""",
        "operation_date payment_period data_doc",
    ),
    "sp_invalid": ("SELECT * FROM {invalid_v}", _INVALID_DATES),
    "ips_balances": ("SELECT * FROM {balances_v}", _BALANCE_DATES),
    "sp_izm_pd": ("SELECT * FROM {changes_v}", _CHANGE_DATES),
    "sp_ogr_pv": ("SELECT * FROM {restrictions_v}", "nach_deistv okon_deistv"),
    "sp_ogr_pv_rev": ("SELECT * FROM {rev_v}", "nach_deistv okon_deistv real_nach_deistv real_okon_deistv"),
    "pension_contracts": ("SELECT * FROM {contracts_v}", _CONTRACT_DATES),
    "contract_periods": ("SELECT * FROM {periods_v}", _PERIOD_DATES),
    "payments_by_contract": ("SELECT * FROM {payments_v}", _PAYMENT_DATES),
    "payments_by_contract_asof": ("SELECT * FROM {payments_v}", _PAYMENT_DATES),
    "paid_by_contract": (
        """SELECT ssylka_fl, ref_kodinsz, data_nach_vypl, count(*) AS payments, sum(summa) AS paid
           FROM {payments_v} GROUP BY ALL""",
        "data_nach_vypl",
    ),
    "restrictions_by_contract": (
        "SELECT * FROM {imp_v}",
        "nach_deistv okon_deistv real_nach_deistv real_okon_deistv data_nach_vypl",
    ),
    "restrictions_fixed": (
        "SELECT * FROM {imp_fixed_v}",
        "nach_deistv okon_deistv real_nach_deistv real_okon_deistv data_nach_vypl",
    ),
    "addendum_segments": (
        "SELECT * FROM {segments_v}",
        "from_month from_date end_date alt_date_begin alt_date_end last_day_from_month",
    ),
    "addendum_months": ("SELECT * FROM {months_v}", "from_date end_date"),
    "pay_order_periods": (
        """SELECT *, CAST(date_trunc('month', payment_period) AS DATE) AS start_month,
                  last_day(payment_period) AS end_month,
                  CAST(date_trunc('quarter', payment_period) AS DATE) AS start_quarter,
                  CAST(date_trunc('quarter', payment_period) + INTERVAL 3 MONTH AS DATE) - 1 AS end_quarter,
                  make_date(year(payment_period), if(month(payment_period) > 6, 7, 1), 1) AS start_halfyear,
                  if(month(payment_period) > 6, make_date(year(payment_period), 12, 31),
                     make_date(year(payment_period), 6, 30)) AS end_half_year,
                  make_date(year(payment_period), 1, 1) AS start_year,
                  make_date(year(payment_period), 12, 31) AS end_year,
                  make_date(year(payment_period), 12, 1) AS end_year_month
           FROM {pay_orders}""",
        "payment_period operation_date scheduled_date calculation_date start_month end_month start_quarter "
        "end_quarter start_halfyear end_half_year start_year end_year end_year_month",
    ),
    "pension_agreements": ("SELECT * FROM {agreements_v}", _AGREEMENT_DATES),
    "agreements_active": ("SELECT * FROM {active_v}", _ACTIVE_DATES),
    "agreements_import": (
        """SELECT * EXCLUDE (period_code, fk_base_cntr_type, fk_base_scheme, date_pension_age),
                  lead(effective_date) OVER base AS effective_date_next, row_number() OVER base AS rn,
                  count(*) OVER (PARTITION BY fk_base_contract) AS cnt
           FROM {agreements_v} WINDOW base AS (PARTITION BY fk_base_contract ORDER BY effective_date, fk_contract)""",
        "effective_date expiration_date last_pay_date creation_date last_update effective_date_next",
    ),
    "agreement_periods": ("SELECT * FROM {agreement_periods_v}", _WINDOW_DATES),
    "run_participants": ("SELECT * FROM {paid}", "data_nachisl data_op"),
    "deactivate_agreements": (
        """SELECT * REPLACE (if(fk_contract IN (SELECT fk_contract FROM {active_v} EXCEPT SELECT fk_contract FROM {paid}),
                                2, state) AS state) FROM {pension_agreements}""",
        _TABLE_AGREEMENT_DATES,
    ),
    "activate_agreements": (
        """SELECT * EXCLUDE (hit) REPLACE (if(hit, 1, state) AS state, if(hit, 0, isarhv) AS isarhv)
           FROM (SELECT *, fk_contract IN (SELECT fk_contract FROM {paid} EXCEPT SELECT fk_contract FROM {active_v}) AS hit
                 FROM {pension_agreements}) h""",
        _TABLE_AGREEMENT_DATES,
    ),
    "cancel_restrictions": (
        """SELECT r.* REPLACE (if(r.fk_document_cancel IS NULL AND EXISTS (
                    SELECT 1 FROM {paid} p WHERE p.fk_contract = r.fk_doc_with_acct AND p.data_nachisl >= r.effective_date
                    AND (r.expiration_date IS NULL OR p.data_nachisl <= r.expiration_date)),
                  0, r.fk_document_cancel) AS fk_document_cancel)
           FROM {pay_restrictions} r""",
        "effective_date expiration_date",
    ),
    "reopen_addenda": ("SELECT * FROM {reopened}", _ADDENDUM_DATES),
    "cancel_recent_addenda": (
        f"""SELECT * REPLACE (if(creation_date > {_OP_DATE} - 4 AND serialno > 0
                                 AND fk_pension_agreement IN (SELECT fk_contract FROM {{paid}}), 1, canceled) AS canceled)
            FROM {{reopened}}""",
        _ADDENDUM_DATES,
    ),
    "agreements_without_addenda": (
        """SELECT a.* EXCLUDE (hit, gone) REPLACE (if(hit, 1, if(gone, 2, state)) AS state, if(hit, 0, isarhv) AS isarhv)
           FROM {paid} p JOIN (SELECT *, fk_contract IN (SELECT fk_contract FROM {paid} EXCEPT SELECT fk_contract FROM {active_v}) AS hit,
                                      fk_contract IN (SELECT fk_contract FROM {active_v} EXCEPT SELECT fk_contract FROM {paid}) AS gone
                               FROM {agreements_v}) a USING (fk_contract)
           WHERE p.fk_contract NOT IN (SELECT fk_pension_agreement FROM {pension_agreement_addendums})""",
        _AGREEMENT_DATES,
    ),
    "reconcile_assignments": (
        """SELECT o.fk_doc_with_acct, o.fk_debit, o.fk_asgmt_type, o.paydate, o.amount, o.paydays,
                  n.paydate AS new_pay_date, n.amount AS new_amount, n.paydays AS new_paydays, b.amount AS balance_debit,
                  t.calc_date, t.expiration_date, t.period_code, t.fk_scheme, t.last_pay_date, t.pa_amount,
                  t.fk_base_contract, t.fk_contragent
           FROM   {assignments} o JOIN {agreement_periods_v} t ON t.fk_pension_agreement = o.fk_doc_with_acct
                  LEFT JOIN {assignments_new} n ON n.fk_doc_with_acct = o.fk_doc_with_acct AND n.paydate = o.paydate
                  LEFT JOIN {accounts_balance} b ON b.fk_account = t.fk_debit
           WHERE  o.fk_doc_with_acct IN (
                    SELECT r.fk_doc_with_acct FROM {assignments} r WHERE r.fk_asgmt_type = 2
                    AND NOT EXISTS (SELECT 1 FROM {assignments_new} m WHERE m.fk_doc_with_acct = r.fk_doc_with_acct
                                    AND m.paydate = r.paydate AND round(m.amount, 2) = round(r.amount, 2)))""",
        "paydate new_pay_date calc_date expiration_date last_pay_date",
    ),
    "run_size_compare": (
        """SELECT 'reference' AS tbl, count(*) AS cnt, count(DISTINCT fk_doc_with_acct) AS cnt2
           FROM {assignments} WHERE fk_asgmt_type = 2
           UNION ALL SELECT 'new', count(*), count(DISTINCT fk_doc_with_acct) FROM {assignments_new}""",
        "",
    ),
    "participant_agreement": (
        """SELECT a.fk_contract, a.effective_date, t.ssylka_fl, t.ssylka_ts
           FROM {agreements_v} a JOIN {transform_contragents} t ON t.fk_contract = a.fk_base_contract""",
        "effective_date",
    ),
    "participant_balance": (
        """SELECT ssylka, data_nach_vypl, data_perevoda_5_cx AS transfer_date,
                  CAST(sum(amount) AS DECIMAL(18,2)) AS amount
           FROM {balances_v} GROUP BY ALL""",
        "data_nach_vypl transfer_date",
    ),
    "participant_dossier_contracts": (
        "SELECT * FROM {contracts_v} WHERE ssylka IN (SELECT ssylka_fl FROM {recorded})", _CONTRACT_DATES,
    ),
    "participant_dossier_payments": (
        "SELECT * FROM {vypl_pen} WHERE ssylka_fl IN (SELECT ssylka_fl FROM {recorded})", "data_op data_nachisl",
    ),
    "participant_dossier_balances": (
        "SELECT * FROM {balances_v} WHERE ssylka IN (SELECT ssylka_fl FROM {recorded})", _BALANCE_DATES,
    ),
    "participant_dossier_changes": (
        "SELECT * FROM {changes_v} WHERE ssylka_fl IN (SELECT ssylka_fl FROM {recorded})", _CHANGE_DATES,
    ),
    "participant_dossier_restrictions": (
        "SELECT * FROM {restrictions_v} WHERE ssylka_fl IN (SELECT ssylka_fl FROM {recorded})",
        "nach_deistv okon_deistv",
    ),
    "participant_dossier_invalid": (
        "SELECT * FROM {invalid_v} WHERE ssylka_fl IN (SELECT ssylka_fl FROM {recorded})", _INVALID_DATES,
    ),
    "agreement_dossier_calculation": (
        "SELECT * FROM {agreement_periods_v} WHERE fk_pension_agreement IN (SELECT fk_contract FROM {quarterly})",
        _WINDOW_DATES,
    ),
    "agreement_dossier_agreement": (
        "SELECT * FROM {pension_agreements} WHERE fk_contract IN (SELECT fk_contract FROM {quarterly})",
        _TABLE_AGREEMENT_DATES,
    ),
    "agreement_dossier_contract": (
        "SELECT * FROM {contracts} WHERE fk_document IN (SELECT fk_contract FROM {quarterly})", "",
    ),
    "agreement_dossier_periods": (
        "SELECT * FROM {pension_agreement_periods} WHERE fk_pension_agreement IN (SELECT fk_contract FROM {quarterly})",
        "calc_date check_date creation_date pa_effective_date",
    ),
    "agreement_dossier_restrictions": (
        "SELECT * FROM {pay_restrictions} WHERE fk_doc_with_acct IN (SELECT fk_contract FROM {quarterly})",
        "effective_date expiration_date",
    ),
    "agreement_dossier_addenda": (
        "SELECT * FROM {pension_agreement_addendums} WHERE fk_pension_agreement IN (SELECT fk_contract FROM {quarterly})",
        _ADDENDUM_DATES,
    ),
    "agreement_dossier_balance": (
        """SELECT * FROM {accounts_balance} WHERE fk_account IN (
             SELECT fk_debit FROM {agreements_v} WHERE fk_contract IN (SELECT fk_contract FROM {quarterly}))""",
        "transfer_date update_date",
    ),
    "agreement_dossier_addendum_months": (
        "SELECT * FROM {months_v} WHERE fk_pension_agreement IN (SELECT fk_contract FROM {quarterly})",
        "from_date end_date",
    ),
    "progress_by_state": (
        """SELECT state, min(date_op) AS min_date_op, max(date_op) AS max_date_op, min(creation_date) AS creation_date,
                  max(last_update_date) AS last_update_date, count(*) AS cnt
           FROM {transform_pa_assignments} GROUP BY state""",
        "min_date_op max_date_op creation_date last_update_date",
    ),
    "progress_by_month": (
        """SELECT *, lag(last_update_date) OVER (ORDER BY pay_month) AS prev_update_date,
                  CAST(round(CAST(date_diff('second', lag(last_update_date) OVER (ORDER BY pay_month), last_update_date)
                                  AS DOUBLE) / 60, 2) AS DECIMAL(18,2)) AS duration_min
           FROM  (SELECT CAST(date_trunc('month', date_op) AS DATE) AS pay_month, min(creation_date) AS creation_date,
                         max(last_update_date) AS last_update_date
                  FROM {transform_pa_assignments} GROUP BY 1 HAVING max(last_update_date) IS NOT NULL) m""",
        "pay_month creation_date last_update_date prev_update_date",
    ),
    "progress_listing": (
        "SELECT * FROM {transform_pa_assignments} ORDER BY date_op DESC",
        "date_op creation_date last_update_date",
    ),
    "pay_order_summary": (
        """SELECT *, (SELECT count(*) FROM {assignments} a WHERE a.fk_doc_with_action = g.fk_pay_order) AS cnt_assignments,
                  (SELECT min(paydate) FROM {assignments} a WHERE a.fk_doc_with_action = g.fk_pay_order) AS min_paydate,
                  (SELECT max(paydate) FROM {assignments} a WHERE a.fk_doc_with_action = g.fk_pay_order) AS max_paydate
           FROM  (SELECT t.ssylka_doc, t.fk_pay_order, o.operation_date, o.payment_period, min(t.date_op) AS min_date_op,
                         max(t.date_op) AS max_date_op, count(DISTINCT t.date_op) AS cnt_date_op
                  FROM   {transform_pa_assignments} t JOIN {transform_po} o ON o.fk_document = t.fk_pay_order
                  WHERE  t.ssylka_doc IS NOT NULL GROUP BY ALL) g
           WHERE  fk_pay_order IN (SELECT fk_doc_with_action FROM {assignments})""",
        "operation_date payment_period min_date_op max_date_op min_paydate max_paydate",
    ),
    "run_span_summary": (
        """SELECT min(o.operation_date) AS min_operation_date, max(o.operation_date) AS max_operation_date,
                  min(a.paydate) AS min_paydate, max(a.paydate) AS max_paydate, count(*) AS cnt
           FROM {assignments} a JOIN {pay_orders} o ON o.fk_document = a.fk_doc_with_action""",
        "min_operation_date max_operation_date min_paydate max_paydate",
    ),
    "apply_corrections": (
        """SELECT d.* REPLACE (coalesce(c.kod_insz, d.kod_insz) AS kod_insz,
                               coalesce(c.ref_kodinsz, d.ref_kodinsz) AS ref_kodinsz)
           FROM {reer_doc_ngpf} d LEFT JOIN {corrections} c ON c.ssylka = d.ssylka""",
        "data_doc",
    ),
    "backfill_contract_ref": (
        """SELECT d.* REPLACE (coalesce((
                    SELECT max(a.fk_contract)
                    FROM   {pension_agreements} a JOIN {contracts} b ON b.fk_document = a.fk_base_contract
                           JOIN {transform_contragents} t ON t.fk_contract = b.fk_document
                           JOIN {sp_pen_dog_unlinked} u ON u.ssylka = t.ssylka_fl AND u.data_nach_vypl = a.effective_date
                                AND u.razm_pen = a.amount
                    WHERE  u.ref_kodinsz IS NULL AND u.ssylka = d.ssylka), d.ref_kodinsz) AS ref_kodinsz)
           FROM {sp_pen_dog_unlinked} d""",
        _SOURCE_CONTRACT_DATES,
    ),
    "correct_contragents": (
        """SELECT t.* REPLACE (coalesce(c.ssylka_fl, t.ssylka_fl) AS ssylka_fl)
           FROM {transform_contragents} t LEFT JOIN {contragent_corrections} c USING (fk_contract)""",
        "",
    ),
    "capture_run": (
        f"""SELECT 'filter' AS part, id, fk_pay_order FROM {{order_filters}} WHERE fk_pay_order NOT IN (
              SELECT fk_document FROM {{pay_orders}} WHERE operation_date = {_OP_DATE} AND fk_pay_order_type = 5)
            UNION ALL
            SELECT 'assignment', id, fk_doc_with_action FROM {{assignments}} WHERE fk_doc_with_action IN (
              SELECT fk_document FROM {{pay_orders}} WHERE operation_date = {_OP_DATE} AND fk_pay_order_type = 5)""",
        "",
    ),
    "purge_runs": (
        """SELECT 1 AS step, 'debt_withholdings' AS tbl, count(*) AS rows_removed, CAST(0 AS BIGINT) AS rows_left,
                  (SELECT array_to_string(json_keys(to_json(x)), ',') FROM (SELECT * FROM {debt_withholdings} LIMIT 1) x) AS columns_left
           FROM {debt_withholdings}
           UNION ALL
           SELECT 2, 'assignments', count(*), 0,
                  (SELECT array_to_string(json_keys(to_json(x)), ',') FROM (SELECT * FROM {assignments} LIMIT 1) x) FROM {assignments}
           UNION ALL
           SELECT 3, 'pay_orders', count(*), 0,
                  (SELECT array_to_string(json_keys(to_json(x)), ',') FROM (SELECT * FROM {pay_orders} LIMIT 1) x) FROM {pay_orders}""",
        "",
    ),
    "run_folders": (
        f"""SELECT a.* FROM {{assignments}} a WHERE a.fk_doc_with_action NOT IN (
              SELECT fk_document FROM {{pay_orders}} WHERE fk_pay_order_type = 5
              AND operation_date IN ({_OP_DATE}, DATE '1998-08-10'))
            UNION ALL
            SELECT n.* FROM {{assignments_new}} n WHERE n.fk_doc_with_action IN (
              SELECT fk_document FROM {{pay_orders}} WHERE operation_date = {_OP_DATE} AND fk_pay_order_type = 5)""",
        _ASSIGNMENT_DATES,
    ),
    "reject_tables": (
        """WITH widths(tbl, n) AS (VALUES ('ERR$_ASSIGNMENTS', 28), ('ERR$_ACCOUNTS_BALANCE', 4), ('ERR$_IMP_DOCUMENTS', 1),
                  ('ERR$_IMP_CONTRACTS', 7), ('ERR$_IMP_PENSION_AGREEMENTS', 12), ('ERR$_IMP_ACCOUNTS', 5),
                  ('ERR$_IMP_PAY_ORDERS', 8), ('ERR$_IMP_ASSIGNMENTS', 28), ('ERR$_IMP_PAY_PORTFOLIOS', 0),
                  ('ERR$_IMP_PAY_DECISIONS', 0), ('ERR$_PENSION_AGREEMENT_ADDEND', 9), ('ERR$_IMP_PAY_RESTRICTIONS', 5)),
                rejected AS (
                  SELECT 'ERR$_ACCOUNTS_BALANCE' AS tbl, 2291 AS error_number, count(*) AS cnt FROM {accounts_balance}
                  WHERE fk_account NOT IN (SELECT id FROM {accounts})
                  UNION ALL
                  SELECT 'ERR$_IMP_PENSION_AGREEMENTS', 2290, count(*) FROM {pension_agreements} WHERE day(date_pension_age) <> 1
                  UNION ALL
                  SELECT 'ERR$_IMP_PAY_RESTRICTIONS', 1400, count(*) FROM {pay_restrictions} WHERE expiration_date IS NULL)
           SELECT tbl, CAST(n + 4 AS INTEGER) AS n_columns, CAST(NULL AS INTEGER) AS error_number,
                  CAST(NULL AS VARCHAR) AS error_tag, CAST(0 AS BIGINT) AS cnt FROM widths
           UNION ALL
           SELECT tbl, n + 4, error_number, 'import', cnt FROM widths JOIN rejected USING (tbl) WHERE cnt > 0""",
        "",
    ),
    "monthly_import": (
        """SELECT CAST(year(date_op) * 100 + month(date_op) AS INTEGER) AS month, 'C' AS state,
                  TIMESTAMP '1998-09-01 12:00:00' AS last_update_date, count(*) AS control_rows,
                  CAST(sum(n) AS BIGINT) AS payments, sum(s) AS paid
           FROM {transform_pa_assignments}
                JOIN (SELECT data_op AS date_op, ssylka_doc, count(*) AS n, sum(summa) AS s FROM {vypl_pen} GROUP BY ALL)
                USING (date_op, ssylka_doc)
           GROUP BY ALL""",
        "last_update_date",
    ),
    "reconcile_two_way": (
        """SELECT * FROM (
             SELECT fk_doc_with_acct, paydate, amount, coalesce(r.n, 0) AS cnt_reference, coalesce(w.n, 0) AS cnt_new
             FROM (SELECT fk_doc_with_acct, paydate, round(amount, 2) AS amount, count(*) AS n FROM {assignments}
                   WHERE fk_asgmt_type = 2 GROUP BY ALL) r
             FULL JOIN (SELECT fk_doc_with_acct, paydate, round(amount, 2) AS amount, count(*) AS n FROM {assignments_new}
                        WHERE fk_asgmt_type = 2 GROUP BY ALL) w USING (fk_doc_with_acct, paydate, amount))
           WHERE cnt_reference <> cnt_new""",
        "paydate",
    ),
    "ips_balance_sizes": (
        """SELECT ssylka, count(DISTINCT (date_op, amount, shifr_schet, sub_shifr_schet, tip_lits, i)) AS movements,
                  count(DISTINCT ref_kodinsz) AS contracts, count(*) AS balances
           FROM  (SELECT c.ssylka, c.ref_kodinsz, m.* EXCLUDE (ssylka)
                  FROM (SELECT *, row_number() OVER () AS i FROM {moves_v}) m JOIN {sp_pen_dog} c USING (ssylka)
                  WHERE c.shema_dog IN (2, 3, 4, 5, 8) AND c.nom_vkl <> 1001) GROUP BY ssylka""",
        "",
    ),
    "payment_due_dates": (
        """SELECT DISTINCT ssylka_fl, data_nachisl, data_op,
                  CAST(if(data_nachisl = last_day(data_nachisl), last_day(data_nachisl + INTERVAL 1 MONTH),
                          data_nachisl + INTERVAL 1 MONTH) AS DATE) AS next_month,
                  CAST(if(data_nachisl = last_day(data_nachisl), last_day(data_nachisl - to_months(tip_vypl)),
                          data_nachisl - to_months(tip_vypl)) AS DATE) AS earlier_month
           FROM {vypl_pen}""",
        "data_nachisl data_op next_month earlier_month",
    ),
    "backfill_contract_ref_strict": (
        """SELECT d.* REPLACE (coalesce(d.ref_kodinsz, (
                    SELECT max(a.fk_contract)
                    FROM   {pension_agreements} a JOIN {contracts} b ON b.fk_document = a.fk_base_contract
                           JOIN {transform_contragents} t ON t.fk_contract = b.fk_document
                    WHERE  t.ssylka_fl = d.ssylka AND a.effective_date = d.data_nach_vypl AND a.amount = d.razm_pen)) AS ref_kodinsz)
           FROM {sp_pen_dog_unlinked} d""",
        _SOURCE_CONTRACT_DATES,
    ),
    "contracts_without_agreement": (
        """SELECT d.* FROM {sp_pen_dog_unlinked} d LEFT JOIN {pension_agreements} a ON a.fk_contract = d.ref_kodinsz
           WHERE d.shema_dog <> 7 AND a.fk_contract IS NULL""",
        _SOURCE_CONTRACT_DATES,
    ),
}


def _parts(sql: str, found: dict[str, str]) -> dict[str, str]:
    """Fragments and mappings a text needs, each after the ones it needs itself."""
    for name in references(sql):
        if name not in found and name not in BENCHMARK_TABLES:
            text = VIEWS.get(name) or MAPPINGS[name]
            _parts(text, found)
            found[name] = text
    return found


def _plain(sql: str) -> str:
    for name in references(sql):
        sql = sql.replace("{" + name + "}", name)
    return sql.replace("@TS", "TIMESTAMP")


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name, (sql, dates) in ORACLES.items():
        steps = [f"{n} AS ({_plain(t)})" for n, t in _parts(sql, {}).items()]
        steps.append(f"answer AS ({_plain(sql)})")
        shown = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split())
        texts[name] = f"WITH {', '.join(steps)} SELECT *{f' REPLACE ({shown})' if shown else ''} FROM answer"
    return texts
