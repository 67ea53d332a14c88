"""SQL of the upkeep queries, straight from the star-schema tables. Limits and lists are literals."""

from __future__ import annotations

from balcao.catalogue.oracle import SQL as ORACLE
from balcao.catalogue.oracle import (
    BASE,
    CHANNEL,
    CREDITED,
    EARNED,
    LISTED,
    MART,
    MONTHLY,
    PAYOUT_OUT,
    PEOPLE,
    PRESENT,
    PREVIOUS,
    SALE,
    SECOND,
    SOLD,
    STAFF,
    TRAINEES,
    WITH_TARGET,
    achieved,
    payout,
    with_,
)

_USABLE = """base AS (
  SELECT CAST(branch AS VARCHAR) || CAST(code AS VARCHAR) AS id, * FROM staff
  WHERE code % 19 <> 5 AND code % 23 <> 7 AND role IN ('FARMACEUTICO', 'OPERADOR DE CAIXA', 'OPERADORA DE CAIXA',
    'GERENTE', 'GERENTE FARMACEUTICO', 'PROMOTOR DE VENDAS', 'SUBGERENTE'))"""
_USABLE_SECOND = """second AS (
  SELECT CAST(b AS VARCHAR) || CAST(code AS VARCHAR) AS id, b AS branch, code FROM (
    SELECT (branch + 1) % 25 AS b, code FROM staff WHERE code % 20 = 4
    UNION ALL SELECT branch, code FROM staff WHERE code % 20 = 4))"""
_CODE_TEXT = "code || CASE WHEN code % 2 = 0 THEN '.0' ELSE '' END"



def _digit(digits: str, size: int) -> str:
    """The check digit that follows ``size`` digits, as text."""
    total = " + ".join(f"CAST(substr({digits}, {i + 1}, 1) AS INT) * {size + 1 - i}" for i in range(size))
    return f"CAST(CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END AS VARCHAR)"


_BROKEN = """known AS (SELECT * FROM staff WHERE code % 37 <> 2),
listed_twice AS (
  SELECT (branch + 1) % 25 AS b, code FROM staff WHERE code % 10 = 4
  UNION ALL SELECT branch, code FROM staff WHERE code % 20 = 4),
marks AS (
  SELECT 'VENDAS_VENDEDOR: Valor Vendas is an amount or blank' AS rule, 'x' AS key FROM mart WHERE code % 29 = 3
  UNION ALL SELECT 'VENDAS_FILIAL: Filial is unique', '3' FROM (SELECT DISTINCT branch FROM mart WHERE branch = 3), (VALUES (1), (2))
  UNION ALL SELECT 'META_FILIAL: CMV is a percentage or blank', 'n/d' FROM (SELECT DISTINCT branch FROM mart WHERE branch = 9)
  UNION ALL SELECT 'COMISSOES: Código refers to filtered_user', CAST(code AS VARCHAR) FROM mart WHERE code % 37 = 2
  UNION ALL SELECT 'filtered_user: Filial, Código is unique', branch || '|' || code FROM known, (VALUES (1), (2)) WHERE code % 31 = 1
  UNION ALL SELECT 'TRAINEES: Filial, Código refers to filtered_user or 2_META', branch || '|' || code FROM staff
    WHERE code % 10 = 3 AND code % 37 = 2
  UNION ALL SELECT '2_META: Código refers to filtered_user', CAST(code AS VARCHAR) FROM listed_twice WHERE code % 37 = 2
  UNION ALL SELECT '2_META: ID is unique', id FROM (
    SELECT b || '' || code AS id, COUNT(*) OVER (PARTITION BY b || '' || code) AS n FROM listed_twice) WHERE n > 1
  UNION ALL SELECT 'AFASTAMENTOS: Filial, Colaborador refers to filtered_user', branch || '|' || upper(name) FROM staff s
    WHERE code % 17 = 6 AND code % 37 = 2),
rules AS (SELECT unnest([
  'VENDAS_VENDEDOR: Código is a seller code', 'VENDAS_VENDEDOR: Valor Vendas is an amount or blank',
  'VENDAS_FILIAL: Filial is a branch number', 'VENDAS_FILIAL: Filial is unique',
  'VENDAS_FILIAL: Faturamento Total is an amount or blank', 'VENDAS_FILIAL: Custo Total is an amount or blank',
  'VENDAS_548: Filial is unique', 'VENDAS_548: 40% VT is an amount or blank',
  'COMISSOES: Filial is a branch number', 'COMISSOES: Valor Comissão is an amount or blank',
  'COMISSOES: Código refers to filtered_user', 'filtered_user: Filial is a branch number',
  'filtered_user: Código is a seller code', 'filtered_user: Filial, Código is unique',
  'META_FILIAL: CMV is a percentage or blank', 'META_FILIAL: Number is an amount or blank',
  'META_FILIAL: Filial is unique', 'META_FILIAL: Filial refers to VENDAS_FILIAL',
  'TRAINEES: Filial, Código refers to filtered_user or 2_META', '2_META: Filial is a branch number',
  '2_META: ID is unique', '2_META: Código refers to filtered_user',
  'AFASTAMENTOS: Filial, Colaborador refers to filtered_user']) AS rule),
counted AS (SELECT rule, key, COUNT(*) AS n, row_number() OVER (PARTITION BY rule ORDER BY key) AS position FROM marks GROUP BY rule, key)
SELECT rule, CAST(coalesce(SUM(n), 0) AS BIGINT) AS rows, CAST(COUNT(key) AS BIGINT) AS keys,
  coalesce(string_agg(key, ', ' ORDER BY key) FILTER (position <= 5), '') AS shown
FROM rules LEFT JOIN counted USING (rule) GROUP BY rule"""


SQL: dict[str, str] = {
    "quarantined_rows": with_(STAFF)
    + f"""SELECT 'filtered_user' AS "table", 'Filial' AS "column", 'MATRIZ' AS value,
  'not a branch number' AS reason, name AS who FROM staff WHERE code % 19 = 5
UNION ALL SELECT 'filtered_user', 'Código', 'A' || {_CODE_TEXT}, 'not a seller code', name FROM staff WHERE code % 23 = 7
UNION ALL SELECT '2_META', 'Filial', '1.5', 'not a branch number', name FROM staff WHERE code % 20 = 14
UNION ALL SELECT 'META_FILIAL', 'CMV', 'n/d', 'not a percentage', '9' FROM (
  SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  WHERE c_nationkey = 9 LIMIT 1)""",
    "payout_without_quarantined": with_(
        SALE, MART, SOLD, STAFF, _USABLE, _USABLE_SECOND, LISTED, PRESENT, PREVIOUS, WITH_TARGET,
        achieved("with_target"), CHANNEL, CREDITED, EARNED, TRAINEES, payout("achieved_app"),
    )
    + f"SELECT {PAYOUT_OUT} FROM payout",
    "atomic_replace": with_(SALE, MART)
    + """SELECT branch, code, amount * 2 AS amount, 'committed' AS first_writer, 'lost' AS second_writer,
  CAST(2 AS BIGINT) AS version FROM mart""",
    "snapshot_retention": with_(SALE, MART) + "SELECT branch, code, amount * 5 AS amount, CAST(3 AS BIGINT) AS expired FROM mart",
    "staff_ledger": """
SELECT CAST(c_nationkey AS BIGINT) AS "Filial", lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS "CPF",
  c_name || CASE WHEN c_nationkey % 5 = 0 THEN '!' ELSE '' END AS "Nome" FROM customer""",
    "staff_ledger_runs": """
WITH branch AS (SELECT DISTINCT c_nationkey AS b FROM customer)
SELECT CAST(run AS BIGINT) AS run,
  CAST(CASE run WHEN 1 THEN count_if(b <> 24) WHEN 3 THEN count_if(b = 24) ELSE 0 END AS BIGINT) AS new,
  CAST(CASE run WHEN 3 THEN count_if(b % 5 = 0) ELSE 0 END AS BIGINT) AS changed,
  CAST(CASE run WHEN 3 THEN count_if(b = 3) ELSE 0 END AS BIGINT) AS touched,
  CAST(CASE run WHEN 2 THEN count_if(b <> 24) WHEN 3 THEN count_if(b % 5 <> 0 AND b NOT IN (3, 24)) ELSE 0 END AS BIGINT) AS unchanged,
  CAST(0 AS BIGINT) AS gone
FROM branch, (VALUES (1), (2), (3)) v(run) GROUP BY run""",
    "maintained_sums": with_(SALE)
    + """SELECT CAST(branch AS VARCHAR) AS branch_key, CAST(code AS VARCHAR) AS code_key,
  CAST(SUM(amount) AS DOUBLE) AS amount, CAST(COUNT(*) AS BIGINT) AS lines FROM (
    SELECT strftime(sold_at, '%Y-%m') AS month, branch, code,
      SUM(cash * CASE WHEN strftime(sold_at, '%m') = '03' THEN 2 ELSE 1 END) AS amount FROM sale GROUP BY ALL)
WHERE month NOT IN ('1996-05', '1999-03') AND NOT (branch = 3 AND month LIKE '%-03') GROUP BY branch, code""",
    "tax_id_repair": f"""
WITH nine AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 % 1000000000 AS VARCHAR), 9, '0') AS d FROM customer),
ten AS (SELECT c_custkey, d || {_digit('d', 9)} AS d FROM nine),
whole AS (SELECT c_custkey, d || {_digit('d', 10)} AS d FROM ten),
shown AS (SELECT *, CASE c_custkey % 5
    WHEN 0 THEN substr(d, 1, 3) || '.' || substr(d, 4, 3) || '.' || substr(d, 7, 3) || '-' || substr(d, 10)
    WHEN 1 THEN ltrim(d, '0') WHEN 2 THEN substr(d, 1, 10) || CAST(9 - CAST(substr(d, 11) AS INT) AS VARCHAR)
    WHEN 3 THEN 'sem CPF' ELSE d END AS written FROM whole)
SELECT c_custkey, written,
  CASE c_custkey % 5 WHEN 3 THEN '' WHEN 2 THEN written ELSE d END AS cpf,
  CASE WHEN d = repeat(substr(d, 1, 1), 11) THEN 'unrepairable' ELSE CASE c_custkey % 5 WHEN 3 THEN 'missing' WHEN 2 THEN 'unrepairable'
    WHEN 1 THEN CASE WHEN d LIKE '0%' THEN 'padded' ELSE 'valid' END ELSE 'valid' END END AS cpf_state
FROM shown""",
    "people_first_ids": with_(PEOPLE)
    + """SELECT side, CAST(position AS INT) AS position, cpf FROM (
  SELECT side, cpf, row_number() OVER (PARTITION BY side ORDER BY cpf) AS position FROM (
    SELECT DISTINCT 'hr' AS side, cpf FROM hr UNION SELECT DISTINCT 'pos', cpf FROM pos
    UNION SELECT DISTINCT 'both', cpf FROM hr WHERE cpf IN (SELECT cpf FROM pos))) WHERE position <= 10""",
    "people_first_values": with_(PEOPLE)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(position AS INT) AS position, value FROM (
  SELECT CAST({c} AS VARCHAR) AS value, row_number() OVER (ORDER BY CAST(branch AS BIGINT), CAST(code AS BIGINT)) AS position
  FROM matched WHERE '{c}' <> 'title' OR branch <> '0') WHERE position <= 5"""
        for c in ("branch", "code", "cpf", "name", "title")
    ),
    "people_in_order": with_(PEOPLE)
    + """SELECT branch, row_number() OVER (ORDER BY CASE WHEN branch <> 'MATRIZ' THEN CAST(branch AS INT) END NULLS LAST) AS place,
  rows, CAST(0 AS BIGINT) AS misplaced, TRUE AS apart
FROM (SELECT CASE WHEN branch = '4' THEN 'MATRIZ' ELSE branch END AS branch, COUNT(*) AS rows FROM matched GROUP BY 1)""",
    "staff_in_branch_order": """
SELECT CAST(c_nationkey AS VARCHAR) AS branch, row_number() OVER (ORDER BY c_nationkey) AS place,
  COUNT(*) AS rows, CAST(0 AS BIGINT) AS misplaced, TRUE AS apart FROM customer GROUP BY c_nationkey""",
    "tab_read": """
SELECT ' ' || c_nationkey AS "ID", 'loja; "' || c_nationkey || '"' AS "Nome", CAST(COUNT(*) AS VARCHAR) AS "Clientes",
  CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE 'x' END AS "Marca" FROM customer GROUP BY c_nationkey""",
    "empty_guard": with_(SALE, MART)
    + """SELECT branch, code, amount, 'True False refused' AS outcomes, 'branch code amount' AS header FROM mart""",
    "required_columns": with_(STAFF, SALE, MART)
    + """SELECT * FROM (VALUES
  ('VENDAS_VENDEDOR', 'VENDAS_VENDEDOR lacks columns [''Valor Vendas'']', (SELECT COUNT(*) FROM mart)),
  ('COMISSOES', 'COMISSOES lacks columns [''Valor Comissão'']', (SELECT COUNT(*) FROM mart)),
  ('VENDAS_FILIAL', 'VENDAS_FILIAL lacks columns [''Custo Total'']', (SELECT COUNT(DISTINCT branch) FROM mart)),
  ('META_FILIAL', 'META_FILIAL lacks columns [''CMV'']', (SELECT COUNT(DISTINCT branch) FROM mart)),
  ('TRAINEES', 'absent', (SELECT COUNT(*) FROM staff WHERE code % 10 = 3)),
  ('2_META', 'absent', (SELECT count_if(code % 10 = 4) + count_if(code % 20 = 4) FROM staff)),
  ('AFASTAMENTOS', 'absent', (SELECT COUNT(*) FROM staff WHERE code % 17 = 6)),
  ('VENDAS_548', 'absent', (SELECT COUNT(*) FROM mart WHERE code = 5))) t("table", outcome, rows), (SELECT CAST(0 AS BIGINT) AS read)""",
    "contract_checks": "WITH " + ",\n".join((STAFF, SALE, MART, _BROKEN)),
    "dropped_rows": with_(SALE, MONTHLY)
    + """SELECT * FROM (
  SELECT step, month AS file, outcome, CAST(CASE step || ' ' || outcome
      WHEN 'sellers kept' THEN COUNT(*)
      WHEN 'sellers names a branch' THEN COUNT(DISTINCT branch)
      WHEN 'sellers holds no seller code' THEN COUNT(DISTINCT branch)
      WHEN 'commissions kept' THEN count_if(branch % 9 <> 8)
      WHEN 'commissions names a branch' THEN COUNT(DISTINCT branch)
      WHEN 'commissions holds no seller code' THEN COUNT(DISTINCT branch)
      WHEN 'commissions stands under no branch' THEN 1 + count_if(branch % 9 = 8)
      WHEN 'branch_totals kept' THEN COUNT(DISTINCT branch) FILTER (branch % 7 <> 3)
      WHEN 'branch_totals names a branch' THEN COUNT(DISTINCT branch) FILTER (branch % 7 <> 3)
      WHEN 'branch_totals sales of a product group' THEN COUNT(DISTINCT branch) FILTER (branch % 7 <> 4)
      WHEN 'branch_totals total under no branch' THEN COUNT(DISTINCT branch) FILTER (branch % 7 = 3)
      WHEN 'branch_totals belongs to no record' THEN COUNT(*) END AS BIGINT) AS rows
  FROM monthly, (VALUES ('sellers', 'kept'), ('sellers', 'names a branch'), ('sellers', 'holds no seller code'),
    ('commissions', 'kept'), ('commissions', 'names a branch'), ('commissions', 'holds no seller code'),
    ('commissions', 'stands under no branch'), ('branch_totals', 'kept'), ('branch_totals', 'names a branch'),
    ('branch_totals', 'sales of a product group'), ('branch_totals', 'total under no branch'),
    ('branch_totals', 'belongs to no record')) v(step, outcome) GROUP BY step, month, outcome
  UNION ALL SELECT 'channel', month || '-' || code, unnest(['kept', 'names no branch']), COUNT(*) FROM monthly GROUP BY month, code
  UNION ALL SELECT 'pos_staff', 'staff-' || c_nationkey, 'kept', count_if(c_custkey % 50 NOT IN (7, 9)) FROM customer GROUP BY c_nationkey
  UNION ALL SELECT 'pos_staff', 'staff-' || c_nationkey, 'dummy code', count_if(c_custkey % 50 = 7) FROM customer GROUP BY c_nationkey
  UNION ALL SELECT 'pos_staff', 'staff-' || c_nationkey, 'code is no number', COUNT(*) + count_if(c_custkey % 50 = 9) FROM customer GROUP BY c_nationkey
) WHERE rows > 0""",
    "people_left_out": with_(STAFF, BASE, SECOND, PEOPLE)
    + """SELECT step, side, outcome, COUNT(*) AS rows FROM (
  SELECT 'second_targets' AS step, '2_META' AS side, CASE WHEN id IN (SELECT id FROM base) THEN 'already on the roster'
    WHEN code NOT IN (SELECT code FROM base) THEN 'nobody on the roster has the code' ELSE 'kept' END AS outcome FROM second
  UNION ALL SELECT 'match_people', 'hr', CASE WHEN c_custkey % 100 = 99 THEN 'no tax id'
    WHEN c_custkey % 25 = 4 THEN 'tax id is not on the other side' ELSE 'kept' END FROM customer
  UNION ALL SELECT 'match_people', 'pos', CASE WHEN c_custkey % 25 = 4 THEN 'no tax id'
    WHEN c_custkey % 100 = 99 THEN 'tax id is not on the other side' ELSE 'kept' END
    FROM customer JOIN (VALUES (1), (2)) v(copy) ON copy = 1 OR c_custkey % 10 = 1) GROUP BY ALL""",
    "key_overlap_sketches": with_(PEOPLE)
    + """SELECT 'hr' AS side, COUNT(DISTINCT cpf) AS ids, TRUE AS within FROM hr
UNION ALL SELECT 'pos', COUNT(DISTINCT cpf), TRUE FROM pos
UNION ALL SELECT 'both', COUNT(DISTINCT cpf), TRUE FROM hr WHERE cpf IN (SELECT cpf FROM pos)""",
    "payout_by_rules": ORACLE["payout_final"],
    "dated_order_bonus": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS orders, COUNT(bonus) AS with_bonus, SUM(bonus) AS bonus FROM (
  SELECT o_orderdate, CAST(CASE
    WHEN CAST(o_orderdate AS DATE) <= DATE '1996-06-15' THEN
      CASE WHEN o_totalprice >= 200000 THEN 25 WHEN o_totalprice >= 100000 THEN 10 END
    WHEN o_totalprice >= 150000 THEN 20
    WHEN o_totalprice >= 50000 AND year(o_orderdate) = 1997 THEN 5 END AS DOUBLE) AS bonus FROM orders) GROUP BY 1""",
}
