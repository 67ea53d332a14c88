"""Names and numbers the business rules are defined by.

Everything in this file is a fixed value: results are only right if these match
the source system's own lists, labels and thresholds exactly.
"""

# Roles that take part in the commission scheme.
COMMISSIONED_ROLES = (
    "FARMACEUTICO",
    "OPERADOR DE CAIXA",
    "OPERADORA DE CAIXA",
    "GERENTE",
    "GERENTE FARMACEUTICO",
    "PROMOTOR DE VENDAS",
    "SUBGERENTE",
)

# Roles paid from the branch scorecard.
MANAGER_ROLES = ("GERENTE", "SUBGERENTE", "GERENTE FARMACEUTICO")

# Seller codes left out of the health-and-beauty report.
HB_IGNORED_CODES = (548, 300, 3)

# What the source reports are asked for.
CHANNEL_SELLER_CODE = "548"
HB_PRODUCT_GROUP = "8000"
HB_EXCLUDED_DEPARTMENTS = ("20", "39", "115")

# Dummy codes and page footer in the point-of-sale staff list.
POS_DUMMY_CODES = ("123456789", "987654321", "987654322", "Página 1 de")

# Zero-based row holding the column names in each report.
HEADER_ROW = {
    "sellers": 9,
    "hb_sellers": 9,
    "channel": 9,
    "commissions": 10,
    "pos_staff": 8,
    "branch_totals": 0,
}

# Share of app-channel sales credited to a branch's sellers.
CHANNEL_SHARE = 0.4

# Payout rules. Attainment is achieved / target.
HALF_PAY_BELOW = 0.80
BONUS_STEPS = ((1.10, 150.0), (1.05, 75.0))

# Scorecard steps as (percent of target, reward), best first.
REVENUE_STEPS = ((104, 300.0), (102, 250.0), (100, 200.0))
TICKET_STEPS = ((110, 300.0), (105, 250.0), (100, 200.0))
# Cost steps as (points against target, reward); lower cost is better.
COST_STEPS = ((-2, 300.0), (-1, 250.0), (0, 200.0))
COMMISSION_SHARE_ON_TARGET = 0.10
COMMISSION_SHARE_BELOW_TARGET = 0.05

# Column names of the tables as users see them.
CALC_COLUMNS = (
    "ID",
    "Filial",
    "Código",
    "Colaborador",
    "Meta",
    "Valor Realizado",
    "VR + 40% APP",
    "Progresso",
    "Função",
    "Premiação Acomul.",
    "Premiação Paga",
    "BONUS",
    "Premiação TOTAL",
)
SCORECARD_COLUMNS = ("Filial", "Fat. Líquido", "CMV", "HB", "TKT Médio", "% Premiação Total")
PEOPLE_COLUMNS = ("Filial", "Código", "CPF", "Nome", "Cargo atual")
SELLER_COLUMNS = ("Filial", "Código", "Vendedor", "Valor Vendas")
HB_COLUMNS = ("Código", "Vendedor", "Valor Vendas")
CHANNEL_COLUMNS = ("Filial", "Valor Vendas", "40% VT")
BRANCH_SALES_COLUMNS = (
    "Filial",
    "Faturamento HB",
    "Custo Total",
    "Faturamento Total",
    "Ticket Médio",
)
COMMISSION_COLUMNS = (
    "Filial",
    "Código",
    "Colaborador",
    "Base Comissão",
    "% Comissão",
    "Valor Comissão",
)
BRANCH_TARGET_COLUMNS = ("Filial", "Number", "HB", "TKT MÉDIO", "CMV")
PERSON_LIST_COLUMNS = ("ID", "Filial", "Código", "Colaborador")
LEAVE_COLUMNS = ("Filial", "Colaborador")
# Lists that people keep by hand.
MANUAL_TABLES = ("META_FILIAL", "TRAINEES", "2_META", "AFASTAMENTOS")
HR_COLUMNS = (
    "Filial",
    "CPF",
    "Nome",
    "Cargo atual",
    "e-mail",
    "Cidade",
    "Sexo",
    "Deficiência",
    "País de nascimento",
    "Data de nascimento",
    "Idade",
    "Data de admissão",
    "Data de desligamento",
    "Salário atual",
)

# Other names an e-mail column goes by in HR extracts.
EMAIL_ALIASES = ("e-mail", "email", "mail", "correio")

# Texts that stand for a missing value in HR extracts.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Columns of the channel report that never hold the branch.
CHANNEL_DROPPED_COLUMNS = (
    "unnamed: 0",
    "unnamed: 1",
    "código",
    "vendedor",
    "qtd. vendas",
    "unnamed: 6",
    "valor custo",
    "margem lucro",
)
