"""Independent SQL for the queries, in DuckDB's dialect.

The SQL computes the expected result straight from the star-schema tables. It never
builds the text tables or report grids the queries go through.
"""

from __future__ import annotations

# Expected values, written out here so that a wrong constant of the engine shows.
ROLES = (
    "FARMACEUTICO",
    "OPERADOR DE CAIXA",
    "OPERADORA DE CAIXA",
    "GERENTE",
    "GERENTE FARMACEUTICO",
    "PROMOTOR DE VENDAS",
    "SUBGERENTE",
)
OTHER_TITLES = ("REPOSITOR", "AUXILIAR - ESTOQUE")
MANAGER_ROLES = ("GERENTE", "SUBGERENTE", "GERENTE FARMACEUTICO")
REVENUE_STEPS = ((104, 300), (102, 250), (100, 200))
TICKET_STEPS = ((110, 300), (105, 250), (100, 200))


def r2(x: str) -> str:
    return f"CAST(printf('%.2f', {x}) AS DOUBLE)"


def zero_signed(x: str) -> str:
    return f"translate(format('{{:,.2f}}', {x}), ',.', '.,')"


def br(x: str) -> str:
    return f"replace({zero_signed(x)}, '-0,00', CASE WHEN {zero_signed(x)} = '-0,00' THEN '0,00' ELSE '-0,00' END)"


def pct(x: str) -> str:
    d = f"CAST(CAST(round_even(({x} - trunc({x})) * 100, 0) AS BIGINT) AS VARCHAR)"
    return (
        f"CAST(CAST(trunc({x}) AS BIGINT) AS VARCHAR) || ',' || "
        f"CASE WHEN length({d}) < 2 THEN lpad({d}, 2, '0') ELSE {d} END || '%'"
    )


def text_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def case_pick(values, index: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {index} % {len(values)} {arms} END"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


SALE = """sale AS (
  SELECT CAST(c_nationkey AS BIGINT) AS branch, l_suppkey AS code, l_orderkey, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS cash, o_orderdate AS sold_at
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey)"""
MART = """mart AS (
  SELECT branch, code, CAST(SUM(cash) AS DOUBLE) AS amount FROM sale GROUP BY branch, code)"""
MONTHLY = """monthly AS (
  SELECT strftime(sold_at, '%Y-%m') AS month, branch, code, CAST(SUM(cash) AS DOUBLE) AS amount
  FROM sale GROUP BY ALL)"""
SOLD = """sold AS (SELECT code, CAST(SUM(cash) AS DOUBLE) AS amount FROM sale GROUP BY code)"""
ROLE_OF_CODE = case_pick([f"'{r}'" for r in (*ROLES, *OTHER_TITLES)], "s_suppkey")
STAFF = f"""staff AS (
  SELECT CAST(s_nationkey AS BIGINT) AS branch, s_suppkey AS code, s_name AS name,
         {ROLE_OF_CODE} AS role FROM supplier)"""
BASE = f"""base AS (
  SELECT CAST(branch AS VARCHAR) || CAST(code AS VARCHAR) AS id, * FROM staff
  WHERE role IN ({text_list(ROLES)}))"""
SECOND = """second AS (
  SELECT CAST(b AS VARCHAR) || CAST(code AS VARCHAR) AS id, b AS branch, code FROM (
    SELECT (branch + 1) % 25 AS b, code FROM staff WHERE code % 10 = 4
    UNION ALL SELECT branch, code FROM staff WHERE code % 20 = 4))"""
LISTED = """listed AS (
  SELECT id, branch, code, name, role FROM base
  UNION ALL
  SELECT s.id, s.branch, b.code, b.name, b.role FROM second s JOIN base b USING (code)
  WHERE s.id NOT IN (SELECT id FROM base))"""
PRESENT = """absent AS (
  SELECT CASE WHEN code % 2 = 0 THEN '' ELSE '0' END || CAST(branch AS VARCHAR) AS branch,
         upper(name) AS name FROM staff WHERE code % 17 = 6),
present AS (
  SELECT id, branch, code, upper(name) AS name, role FROM listed r
  WHERE NOT EXISTS (SELECT 1 FROM absent a
                    WHERE a.branch = CAST(r.branch AS VARCHAR) AND a.name = upper(r.name)))"""
RATIO = case_pick((0.735, 0.825, 0.915, 1.005, 1.06, 1.185), "code")
PREVIOUS = f"""typed AS (
  SELECT code, CASE WHEN code % 11 = 0 THEN NULL WHEN code % 13 = 0 THEN 0.0
                    ELSE {r2(f"amount / ({RATIO})")} END AS target FROM sold),
written AS (
  SELECT CAST(branch AS VARCHAR) || CAST(code AS VARCHAR) AS id, target, code * 4 + 2 AS position
  FROM staff JOIN typed USING (code)
  UNION ALL
  SELECT CAST((branch + 1) % 25 AS VARCHAR) || CAST(code AS VARCHAR), target, code * 4 + 3
  FROM staff JOIN typed USING (code) WHERE code % 10 = 4
  UNION ALL
  SELECT CAST(branch AS VARCHAR) || CAST(code AS VARCHAR), 1.0, code * 4
  FROM staff JOIN typed USING (code) WHERE code % 3 = 0 AND code % 11 <> 0),
previous AS (
  SELECT id, arg_max(target, position) AS target FROM written WHERE target IS NOT NULL GROUP BY id)"""


def achieved(source: str) -> str:
    return f"""achieved AS (
  SELECT p.*, {r2('CASE WHEN p.code IN (SELECT code FROM second) THEN m.amount ELSE s.amount END')} AS achieved
  FROM {source} p LEFT JOIN sold s ON s.code = p.code
  LEFT JOIN mart m ON m.code = p.code AND m.branch = p.branch)"""


WITH_TARGET = """with_target AS (
  SELECT p.*, v.target FROM present p LEFT JOIN previous v USING (id))"""
MANAGERS = text_list(MANAGER_ROLES)
CHANNEL = f"""channel AS (
  SELECT branch, amount AS sales, {r2('amount * 0.4')} AS share FROM mart
  WHERE code = 5)"""
CREDITED = f"""credited AS (
  SELECT a.*, CASE WHEN a.role NOT IN ({MANAGERS}) AND c.share IS NOT NULL
              THEN {r2('coalesce(achieved, 0) + c.share')} ELSE achieved END AS achieved_app
  FROM achieved a LEFT JOIN channel c USING (branch))"""
NO_CHANNEL = "credited AS (SELECT *, achieved AS achieved_app FROM achieved)"
EARNED = f"""earned AS (
  SELECT branch, code, {r2(f'amount * 0.013')} AS commission FROM mart)"""
TRAINEES = """trainee AS (
  SELECT DISTINCT CAST(branch AS VARCHAR) || CAST(code AS VARCHAR) AS id FROM staff
  WHERE code % 10 = 3)"""


def payout(basis: str, trainees: bool = True) -> str:
    trained = "c.id IN (SELECT id FROM trainee)" if trainees else "FALSE"
    return f"""per_code AS (
  SELECT code, nullif(CAST(SUM(CAST(commission AS DECIMAL(18,2))) AS DOUBLE), 0) AS commission
  FROM earned GROUP BY code),
rated AS (
  SELECT c.*, e.commission, {trained} AS is_trainee, c.role IN ({MANAGERS}) AS is_manager,
         CASE WHEN target <> 0 THEN coalesce({basis}, 0) / target END AS ratio
  FROM credited c LEFT JOIN per_code e USING (code)),
decided AS (
  SELECT *, (NOT is_manager OR is_trainee) AND ratio IS NOT NULL AND commission IS NOT NULL AS pays,
         commission * CASE WHEN ratio < 0.8 THEN 0.5 ELSE 1 END AS raw_paid,
         CASE WHEN ratio >= 1.10 THEN 150.0 WHEN ratio >= 1.05 THEN 75.0 END AS raw_bonus
  FROM rated),
payout AS (
  SELECT id, branch, code, name, role, is_manager, is_trainee, target, achieved, achieved_app,
         {r2('ratio * 100')} AS progress, commission AS accrued,
         CASE WHEN pays THEN {r2('raw_paid')} END AS paid,
         CASE WHEN pays THEN CAST(raw_bonus AS DOUBLE) END AS bonus,
         CASE WHEN pays THEN {r2('raw_paid + coalesce(raw_bonus, 0)')} END AS total
  FROM decided)"""


HB_PART = f"""hb_part AS (
  SELECT p_partkey FROM part WHERE p_type = 'ECONOMY'
  AND p_size NOT IN (20, 39, 15))"""
FIGURES = f"""figures AS (
  SELECT CAST(c_nationkey AS BIGINT) AS branch,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         coalesce(CAST(SUM(CASE WHEN l_partkey IN (SELECT p_partkey FROM hb_part)
                  THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS hb,
         {r2('''CAST(SUM(CAST(round(l_extendedprice * 100) AS HUGEINT)
                * CAST(60 + round(l_tax * 100) AS HUGEINT)) AS DOUBLE) / 10000''')} AS cost,
         {r2('CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(DISTINCT l_orderkey)')} AS ticket
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  GROUP BY c_nationkey)"""
COST_OFFSET = case_pick((2.5, 1.5, 0.5, -1.0), "branch")
AIMED = f"""aimed AS (
  SELECT *, CASE WHEN branch = 11 THEN 0.0
            ELSE {r2('revenue / (CAST(0.98 AS DOUBLE) + CAST(0.0155 AS DOUBLE) * CAST(branch % 5 AS DOUBLE))')} END AS revenue_target,
         {r2('hb / (CAST(0.98 AS DOUBLE) + CAST(0.0155 AS DOUBLE) * CAST((branch + 1) % 5 AS DOUBLE))')} AS hb_target,
         {r2('ticket / (CAST(0.97 AS DOUBLE) + CAST(0.045 AS DOUBLE) * CAST(branch % 4 AS DOUBLE))')} AS ticket_target,
         {r2(f"{r2('cost / revenue * 100')} + CAST({COST_OFFSET} AS DOUBLE)")} AS cost_target
  FROM figures)"""


def steps(percent: str, levels) -> str:
    arms = " ".join(f"WHEN {percent} >= {at} THEN {amount}" for at, amount in levels)
    return f"CAST(CASE {arms} END AS DOUBLE)"


def reached(actual: str, target: str) -> str:
    return f"(CASE WHEN {target} > 0 THEN {actual} / {target} * 100 END)"


CARD = f"""branch_earned AS (
  SELECT branch, CAST(SUM(CAST(commission AS DECIMAL(18,2))) AS DOUBLE) AS commission
  FROM earned WHERE branch <> 7 OR code % 2 = 0 GROUP BY branch),
card AS (
  SELECT CAST(branch AS VARCHAR) AS branch_key,
         {steps(reached('revenue', 'revenue_target'), REVENUE_STEPS)} AS revenue_reward,
         CAST(CASE WHEN {r2('cost / revenue * 100 - cost_target')} <= -2 THEN 300
              WHEN {r2('cost / revenue * 100 - cost_target')} <= -1 THEN 250
              WHEN {r2('cost / revenue * 100 - cost_target')} <= 0 THEN 200 END AS DOUBLE) AS cost_reward,
         {steps(reached('hb', 'hb_target'), REVENUE_STEPS)} AS hb_reward,
         {steps(reached('ticket', 'ticket_target'), TICKET_STEPS)} AS ticket_reward,
         {r2('''commission * CASE WHEN revenue_target = 0 OR revenue / revenue_target * 100 >= 100
                THEN 0.1 ELSE 0.05 END''')} AS commission_reward
  FROM aimed LEFT JOIN branch_earned USING (branch)),
reward AS (
  SELECT branch_key, coalesce(revenue_reward, 0) + coalesce(cost_reward, 0) + coalesce(hb_reward, 0)
         + coalesce(ticket_reward, 0) + coalesce(commission_reward, 0) AS reward FROM card)"""
FINAL = f"""final AS (
  SELECT p.id, p.branch, p.code, p.name, p.role, p.is_manager, p.is_trainee, p.target, p.achieved,
         p.achieved_app, p.progress,
         CASE WHEN r.reward IS NOT NULL AND is_manager AND NOT is_trainee THEN NULL ELSE accrued END AS accrued,
         CASE WHEN r.reward IS NOT NULL AND is_manager AND NOT is_trainee THEN NULL ELSE paid END AS paid,
         CASE WHEN r.reward IS NOT NULL AND is_manager AND NOT is_trainee THEN NULL ELSE bonus END AS bonus,
         CASE WHEN r.reward IS NULL THEN total
              WHEN is_trainee THEN {r2('coalesce(total, 0) + r.reward')}
              WHEN is_manager THEN {r2('r.reward')} ELSE total END AS total
  FROM payout p LEFT JOIN reward r ON r.branch_key = CAST(p.branch AS VARCHAR))"""

PAYOUT_OUT = (
    "id, branch, code, role, target, achieved, achieved_app, progress, accrued, paid, bonus, total"
)
TO_LISTED = (STAFF, BASE, SECOND, LISTED)
TO_TARGET = (SALE, MART, SOLD, *TO_LISTED, PRESENT, PREVIOUS, WITH_TARGET)
TO_ACHIEVED = (*TO_TARGET, achieved("with_target"))
TO_CREDITED = (*TO_ACHIEVED, CHANNEL, CREDITED)
TO_PAYOUT = (*TO_CREDITED, EARNED, TRAINEES, payout("achieved_app"))
TO_CARD = (SALE, MART, EARNED, HB_PART, FIGURES, AIMED, CARD)
TO_FINAL = (*TO_PAYOUT, HB_PART, FIGURES, AIMED, CARD, FINAL)

_CODE_KEY = """CASE c_custkey % 3 WHEN 0 THEN replace(CAST(c_custkey AS VARCHAR) || '.0', '.0', '')
  WHEN 1 THEN CAST(c_custkey AS VARCHAR) || '5' ELSE CAST(c_custkey AS VARCHAR) END"""
_BR_PRICE = br("l_extendedprice")
_PLAIN_PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)"
_NBSP = "chr(160)"


def _branch_rows(value: str) -> str:
    return f"CASE WHEN branch % 9 = 8 THEN NULL ELSE {value} END"


def _period(start: str, end: str) -> str:
    return (
        with_(SALE, HB_PART)
        + f"""SELECT branch, COUNT(*) AS lines, CAST(SUM(cash) AS DOUBLE) AS amount FROM sale
WHERE sold_at >= DATE '{start}' AND sold_at < DATE '{end}' + INTERVAL 1 DAY
AND l_partkey IN (SELECT p_partkey FROM hb_part) GROUP BY branch"""
    )


_SIGNED = "CASE WHEN l_orderkey % 97 = 0 THEN CAST(-0.001 AS DOUBLE) ELSE (l_discount - CAST(0.05 AS DOUBLE)) * l_extendedprice * CAST(0.5 AS DOUBLE) END"
_HB_ROWS = f"""hb_rows AS (
  SELECT branch, code, SUM(cash) AS cash,
         CASE WHEN (branch + code) % 4 <> 0 THEN 'V' || code || '/' || branch END AS seller
  FROM sale WHERE l_partkey IN (SELECT p_partkey FROM hb_part) GROUP BY branch, code)"""
_IGNORED = "548, 300, 3"
_PROFILED = ("branch", "code", "cpf", "name", "title")


def _profile() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(COUNT({c}) AS BIGINT) AS non_null,
COUNT(DISTINCT {c}) AS distinct_values,
(SELECT CAST({c} AS VARCHAR) FROM matched ORDER BY CAST(branch AS BIGINT), CAST(code AS BIGINT) LIMIT 1) AS sample
FROM matched"""
        for c in _PROFILED
    )


PEOPLE = """hr AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS branch, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cpf,
         '01 - ' || c_mktsegment AS title FROM customer WHERE c_custkey % 100 <> 99),
pos AS (
  SELECT c_custkey || '0' || copy AS code, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cpf,
         c_name || ' *' AS name
  FROM customer JOIN (VALUES (1), (2)) v(copy)
       ON copy = 1 OR c_custkey % 10 = 1
  WHERE c_custkey % 25 <> 4),
matched AS (SELECT branch, code, cpf, name, title FROM hr JOIN pos USING (cpf))"""


def _calc_money(name: str) -> str:
    return f"coalesce({br(name)}, '')"


SQL: dict[str, str] = {
    "br_number_parse": f"""
SELECT variant, text, COUNT(*) AS n, value FROM (
  SELECT l_orderkey % 8 AS variant,
    CASE l_orderkey % 8 WHEN 0 THEN {_BR_PRICE} WHEN 1 THEN ' ' || {_BR_PRICE} || {_NBSP}
      WHEN 2 THEN {_PLAIN_PRICE} WHEN 3 THEN '(' || {_BR_PRICE} || ')' WHEN 4 THEN 'R$ ' || {_BR_PRICE}
      WHEN 5 THEN '' WHEN 6 THEN '-' || {_BR_PRICE}
      ELSE CASE WHEN l_linenumber % 2 = 1 THEN 'nan' ELSE 'inf' END END AS text,
    CASE l_orderkey % 8 WHEN 0 THEN l_extendedprice WHEN 1 THEN l_extendedprice
      WHEN 2 THEN round(l_extendedprice * 100) WHEN 6 THEN -l_extendedprice END AS value
  FROM lineitem) GROUP BY ALL""",
    "br_number_format": f"""
SELECT value, COUNT(*) AS n, {r2('value')} AS rounded, {br('value')} AS signed,
  {br('abs(value)')} AS unsigned,
  CASE WHEN value < 0 THEN '(' || {br('abs(value)')} || ')' ELSE {br('abs(value)')} END AS parentheses,
  {zero_signed('value')} AS zero_signed
FROM (SELECT {_SIGNED} AS value FROM lineitem) GROUP BY value""",
    "quantity_format": f"""
SELECT text, COUNT(*) AS n, shown FROM (
  SELECT CASE l_orderkey % 3 WHEN 0 THEN CAST(CAST(l_quantity * 1000 AS DECIMAL(18,1)) AS VARCHAR)
           WHEN 1 THEN {_PLAIN_PRICE} ELSE 'x' || l_linenumber END AS text,
    CASE l_orderkey % 3 WHEN 0 THEN replace(format('{{:,}}', CAST(l_quantity * 1000 AS BIGINT)), ',', '.')
      WHEN 1 THEN replace(format('{{:,}}', CAST(floor(l_extendedprice) AS BIGINT)), ',', '.')
        || CASE WHEN l_extendedprice = floor(l_extendedprice) THEN ''
           ELSE '.' || rtrim(split_part({_PLAIN_PRICE}, '.', 2), '0') END
      ELSE 'x' || l_linenumber END AS shown
  FROM lineitem) GROUP BY ALL""",
    "percent_text": f"""
SELECT points, COUNT(*) AS n, {pct('points')} AS text, CASE WHEN points >= 0 THEN points END AS value
FROM (SELECT {r2('o_totalprice / 1000 - 150')} AS points FROM orders) GROUP BY points""",
    "branch_code_keys": f"""
SELECT c_custkey,
  CASE c_custkey % 6 WHEN 4 THEN 'MATRIZ' WHEN 5 THEN 'F' || c_nationkey
    ELSE CAST(c_nationkey AS VARCHAR) END AS branch_key,
  CASE c_custkey % 6 WHEN 2 THEN c_nationkey || '.0' WHEN 4 THEN 'MATRIZ'
    WHEN 5 THEN 'F' || c_nationkey ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS branch_key_zeros,
  CASE c_custkey % 6 WHEN 2 THEN c_nationkey || '.0' WHEN 4 THEN 'MATRIZ'
    WHEN 5 THEN CAST(c_nationkey AS VARCHAR)
    ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS branch_without_f,
  {_CODE_KEY} AS code_key, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS padded,
  CASE WHEN c_custkey % 6 IN (2, 3) THEN CAST(c_nationkey AS DOUBLE) END AS number
FROM customer""",
    "role_extract": """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 2 THEN 'A - ' ELSE '' END || c_mktsegment AS role
FROM customer""",
    "cpf_clean": """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cpf,
  lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS padded FROM customer""",
    "composite_id_collisions": with_(SALE)
    + """SELECT id, COUNT(*) AS people, MIN(branch) AS lowest_branch, MAX(branch) AS highest_branch
FROM (SELECT DISTINCT branch || '' || code AS id, branch, code FROM sale)
GROUP BY id HAVING COUNT(*) > 1""",
    "reporting_period": """
SELECT day,
  CASE WHEN day(day) = 1 THEN CAST(day - INTERVAL 1 MONTH AS DATE) ELSE CAST(date_trunc('month', day) AS DATE) END AS period_start,
  CASE WHEN day(day) = 1 THEN CAST(day - INTERVAL 1 DAY AS DATE) ELSE day END AS period_end
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "days_left": """
SELECT day, CAST(last_day(day) - day + 1 AS BIGINT) AS days_left,
  strftime(last_day(day) + 1, '%m/%Y') AS next_month
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "reporting_period_sales": _period("1998-06-01", "1998-06-20"),
    "reporting_period_sales_on_the_first": _period("1997-04-01", "1997-04-30"),
    "sales_by_seller": with_(SALE, SOLD) + "SELECT code, amount FROM sold",
    "sales_by_branch_seller": with_(SALE, MART) + "SELECT branch, code, amount FROM mart",
    "achieved_hybrid": with_(*TO_ACHIEVED) + "SELECT id, branch, code, achieved FROM achieved",
    "channel_share": with_(SALE, MART, CHANNEL) + "SELECT branch, sales, share FROM channel",
    "achieved_plus_share": with_(*TO_CREDITED)
    + "SELECT id, branch, code, role, achieved, achieved_app FROM credited",
    "attainment": with_(*TO_PAYOUT)
    + f"SELECT id, branch, code, target, progress, {pct('progress')} AS progress_text FROM payout",
    "seller_payout": with_(*TO_PAYOUT) + f"SELECT {PAYOUT_OUT} FROM payout",
    "seller_payout_on_achieved": with_(*TO_CREDITED, EARNED, TRAINEES, payout("achieved"))
    + f"SELECT {PAYOUT_OUT} FROM payout",
    "remaining_to_target": with_(*TO_ACHIEVED)
    + f"""SELECT id, branch, code, {r2('remaining')} AS remaining,
CASE WHEN remaining < 0 THEN '(' || {br('abs(remaining)')} || ')' ELSE {br('abs(remaining)')} END AS remaining_text
FROM (SELECT *, target - coalesce(achieved, 0) AS remaining FROM achieved)""",
    "daily_recommended": with_(*TO_ACHIEVED)
    + f"""SELECT id, branch, code,
CASE WHEN target <> 0 AND target - coalesce(achieved, 0) > 0
THEN {r2('(target - coalesce(achieved, 0)) / 11')} END AS daily_recommended FROM achieved""",
    "single_payout": with_(*TO_ACHIEVED, EARNED)
    + f"""SELECT id, a.branch, a.code, commission,
CASE WHEN ratio IS NOT NULL THEN {r2('''commission * CASE WHEN ratio < 0.8 THEN 0.5 ELSE 1 END
+ CASE WHEN ratio < 1.05 THEN 0 WHEN ratio < 1.10 THEN 75 ELSE 150 END''')} END AS payout
FROM (SELECT *, CASE WHEN target <> 0 THEN coalesce(achieved, 0) / target END AS ratio FROM achieved) a
LEFT JOIN earned e ON e.branch = a.branch AND e.code = a.code""",
    "hb_sales_dedup": with_(SALE, HB_PART, _HB_ROWS)
    + f"""SELECT code, arg_min(seller, branch) FILTER (WHERE seller IS NOT NULL) AS seller,
CAST(SUM(cash) AS DOUBLE) AS amount, COUNT(*) AS rows,
{zero_signed('CAST(SUM(cash) AS DOUBLE)')} AS text
FROM hb_rows WHERE code NOT IN ({_IGNORED}) GROUP BY code""",
    "hb_duplicates": with_(SALE, HB_PART, _HB_ROWS)
    + "SELECT COUNT(*) - COUNT(DISTINCT code) AS duplicates FROM hb_rows",
    "flatten_sellers": with_(SALE, MONTHLY)
    + f"""SELECT {_branch_rows('CAST(branch AS VARCHAR)')} AS "Filial", CAST(code AS VARCHAR) AS "Código",
'V' || code AS "Vendedor", {br('amount')} AS "Valor Vendas" FROM monthly""",
    "flatten_hb_sellers": with_(SALE, MONTHLY)
    + f"""SELECT code AS "Código", 'V' || code AS "Vendedor",
{zero_signed('CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)')} AS "Valor Vendas"
FROM monthly WHERE code NOT IN ({_IGNORED}) GROUP BY code""",
    "flatten_commissions": with_(SALE, MONTHLY)
    + f"""SELECT lpad(CAST(branch AS VARCHAR), 2, '0') AS "Filial", CAST(code AS VARCHAR) AS "Código",
'V' || code AS "Colaborador", {br('amount')} AS "Base Comissão", '1,3' AS "% Comissão",
{br(r2(f'amount * 0.013'))} AS "Valor Comissão" FROM monthly WHERE branch % 9 <> 8""",
    "branch_totals_report": with_(
        SALE,
        """sections AS (
  SELECT strftime(sold_at, '%Y-%m') AS file, branch, CAST(SUM(cash) AS DOUBLE) AS amount
  FROM sale GROUP BY ALL)""",
        """seen AS (
  SELECT *, lag(branch) OVER w AS above, lag(amount) OVER w AS above_amount FROM sections
  WINDOW w AS (PARTITION BY file ORDER BY branch))""",
    )
    + f"""SELECT file, lpad(CAST(branch AS VARCHAR), 2, '0') AS "Filial",
CASE WHEN branch % 7 <> 4 THEN {br('amount')}
     WHEN above % 7 = 3 THEN {br('above_amount')} END AS "Faturamento HB",
{br('amount * 0.5')} AS "Custo Total", {br('amount')} AS "Faturamento Total", '9,99' AS "Ticket Médio"
FROM seen WHERE branch % 7 <> 3""",
    "shift_channel_report": with_(SALE, MONTHLY)
    + f"""SELECT CAST(branch AS VARCHAR) AS "Filial",
CASE WHEN branch % 5 <> 0 THEN amount END AS "Valor Vendas",
CASE WHEN branch % 5 <> 0 THEN {r2('amount * 0.4')} END AS "40% VT" FROM monthly""",
    "shift_pos_staff": """
SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey || '.0' ELSE CAST(c_custkey AS VARCHAR) END AS "Código",
c_name AS "Funcionário",
regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), '^(\\d{3})(\\d{3})(\\d{3})(\\d{2})$', '\\1.\\2.\\3-\\4') AS "CPF"
FROM customer WHERE c_custkey % 50 NOT IN (7, 9)""",
    "roster_base": with_(STAFF, BASE) + "SELECT id, branch, code, name, role FROM base",
    "roster_second_target": with_(*TO_LISTED) + "SELECT id, branch, code, name, role FROM listed",
    "roster_leave_anti": with_(*TO_LISTED, PRESENT)
    + "SELECT id, branch, code, name, role FROM present",
    "target_carry_forward": with_(SALE, SOLD, *TO_LISTED, PREVIOUS)
    + f"""SELECT l.id, branch, code, {br('target')} AS target_text, target
FROM listed l LEFT JOIN previous p USING (id)""",
    "achieved_carry_forward": with_(
        SALE,
        MART,
        STAFF,
        BASE,
        """kept AS (
  SELECT branch || '' || code AS id, arg_max(amount, code * 25 + branch) AS achieved FROM mart GROUP BY 1)""",
    )
    + f"""SELECT b.id, branch, code, {br('achieved')} AS achieved_text, achieved
FROM base b LEFT JOIN kept k USING (id)""",
    "remove_person": with_(STAFF, BASE)
    + "SELECT id, branch, code, name, role FROM base WHERE code <> 2",
    "people_match": with_(PEOPLE) + "SELECT * FROM matched",
    "people_match_stats": with_(PEOPLE)
    + """SELECT CAST((SELECT COUNT(DISTINCT cpf) FROM hr) AS BIGINT) AS hr_ids,
CAST((SELECT COUNT(DISTINCT cpf) FROM pos) AS BIGINT) AS pos_ids,
CAST((SELECT COUNT(DISTINCT cpf) FROM matched) AS BIGINT) AS common_ids""",
    "people_profile": with_(PEOPLE) + _profile(),
    "branch_figures": with_(HB_PART, FIGURES) + "SELECT branch, revenue, hb, cost, ticket FROM figures",
    "branch_scorecard": with_(*TO_CARD) + "SELECT * FROM card JOIN reward USING (branch_key)",
    "payout_final": with_(*TO_FINAL) + f"SELECT {PAYOUT_OUT} FROM final",
    "manager_override": with_(*TO_FINAL)
    + """SELECT id, branch, code, role, is_trainee, accrued, paid, bonus, total FROM final
WHERE is_manager OR is_trainee""",
    "export_view": with_(*TO_FINAL)
    + f"""SELECT id AS "ID", CAST(branch AS VARCHAR) AS "Filial", CAST(code AS VARCHAR) AS "Código",
name AS "Colaborador", {_calc_money('target')} AS "Meta", {_calc_money('achieved')} AS "Valor Realizado",
{_calc_money('achieved_app')} AS "VR + 40% APP", coalesce({pct('progress')}, '') AS "Progresso",
role AS "Função", {_calc_money('accrued')} AS "Premiação Acomul.", {_calc_money('paid')} AS "Premiação Paga",
{_calc_money('bonus')} AS "BONUS", {_calc_money('total')} AS "Premiação TOTAL" FROM final""",
    "scorecard_view": with_(*TO_CARD)
    + f"""SELECT branch_key AS "Filial", {_calc_money('revenue_reward')} AS "Fat. Líquido",
{_calc_money('cost_reward')} AS "CMV", {_calc_money('hb_reward')} AS "HB",
{_calc_money('ticket_reward')} AS "TKT Médio", {_calc_money('commission_reward')} AS "% Premiação Total" FROM card""",
    "optional_tables_missing": with_(
        SALE,
        MART,
        SOLD,
        STAFF,
        BASE,
        "second AS (SELECT code FROM staff WHERE FALSE)",
        "with_target AS (SELECT *, CAST(NULL AS DOUBLE) AS target FROM base)",
        achieved("with_target"),
        NO_CHANNEL,
        EARNED,
        payout("achieved_app", trainees=False),
    )
    + f"SELECT {PAYOUT_OUT} FROM payout",
    "hr_csv_union": f"""
SELECT CAST(c_nationkey AS VARCHAR) AS "Filial", lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS "CPF",
'João; ' || c_name AS "Nome", '01 - ' || c_mktsegment AS "Cargo atual",
CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'c' || c_custkey || '@x.br' END AS "e-mail",
CASE WHEN c_custkey % 5 = 0 THEN 'São Paulo ''SP''' ELSE 'Belém, PA' END AS "Cidade",
CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS "Sexo", 'Não' AS "Deficiência",
'Brasil' AS "País de nascimento", '01/02/1990' AS "Data de nascimento",
CAST(c_custkey % 40 + 20 AS VARCHAR) AS "Idade", '03/04/2020' AS "Data de admissão",
'' AS "Data de desligamento", {br('c_acctbal')} AS "Salário atual" FROM customer""",
    "hr_csv_rejects": """
SELECT CASE n_nationkey % 4 WHEN 0 THEN 'outros - ' || n_nationkey || 'x.csv'
  ELSE 'COLABORADORES - ' || n_nationkey || '.csv' END AS label,
  CASE n_nationkey % 4 WHEN 0 THEN 'no branch in name' WHEN 1 THEN 'unpaired quotes'
  WHEN 2 THEN 'empty' ELSE 'row wider than header' END AS reason FROM nation""",
    "latest_report_file": with_(SALE, MART)
    + """SELECT CAST(branch AS VARCHAR) AS branch_key, CAST(code AS VARCHAR) AS code_key,
amount * 2 AS amount FROM mart""",
    "snapshot_roundtrip": with_(*TO_TARGET, "kept AS (SELECT id, target FROM with_target)")
    + f"""SELECT l.id, l.branch, l.code, CAST('1' || printf('%.2f', k.target) AS DOUBLE) AS target
FROM listed l LEFT JOIN (SELECT id, any_value(target) AS target FROM kept GROUP BY id) k USING (id)""",
    "hb_products_by_brand": f"""
SELECT p_brand, count(*) AS products FROM part
WHERE p_type = 'ECONOMY' AND p_size NOT IN (20, 39, 115) GROUP BY p_brand""",
    "active_staff_by_branch": """
SELECT c_nationkey, count(*) AS people FROM customer WHERE c_custkey % 6 <> 0 GROUP BY c_nationkey""",
    "export_text_clean": r"""
SELECT doc_id, 0 AS variant,
  replace(regexp_replace('"' || chr(9) || text, '[\n\r\t]+', ' ', 'g'), '"', '''') AS clean
FROM documents UNION ALL SELECT doc_id, unnest([1, 2]), '' FROM documents""",
    "blank_missing_values": """
SELECT CAST(event_id AS VARCHAR) AS event_id, '0' AS variant, CAST(value AS VARCHAR) AS amount, '' AS note
FROM events UNION ALL
SELECT CAST(event_id AS VARCHAR), unnest(['1', '2', '3']), '', '' FROM events""",
}
SQL["grid_files_scan"] = SQL["flatten_sellers"]
