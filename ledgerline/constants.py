"""Fixed values of the data product: statuses, labels, line order, thresholds.

They are part of the data contract (stored in tables, shown in reports), so
they are written out literally. Everything that depends on a company or on a
report is only a default: the operators take it as a parameter.
"""

from __future__ import annotations

INFLOW = "entrada"
OUTFLOW = "saida"

# Title statuses.
SETTLED = ("PAGO", "RECEBIDO", "LIQUIDADO")
REALISED = ("RECEBIDO", "PAGO", "LIQUIDADO", "CANCELADO")
PAID = ("PAGO", "RECEBIDO")
OPEN = ("A VENCER", "ATRASADO", "VENCE HOJE")
TO_MATURE = ("A VENCER", "VENCE HOJE")
OVERDUE = "ATRASADO"
RECEIVED = "RECEBIDO"
PAID_OUT = "PAGO"

# Billing modality.
DIRECT = "FD"
NORMAL = "SK"

# Fallback labels.
NO_PROJECT = "Sem projeto"
NO_NAME = "Sem nome"
NOT_INFORMED = "N/I"
UNAVAILABLE_CATEGORY = "<Disponível>"

# Accounts that carry no real cash movement.
IGNORED_ACCOUNTS = (8754849088,)

# Cost buckets by category group.
DIRECT_COST_GROUP = "2.01"
SGA_GROUPS = ("2.02", "2.03", "2.04", "2.10")

# Sales-order stage codes.
ORDER_STAGES = {
    "10": "Em Aberto",
    "20": "Em Aprovação",
    "30": "Aprovado",
    "40": "Separar",
    "50": "Em Separação",
    "60": "Faturado",
    "70": "Cancelado",
    "80": "Entregue",
}

# Bank-account type codes.
ACCOUNT_TYPES = {
    "CC": "Conta Corrente",
    "CR": "Cartão",
    "CG": "Garantida",
    "CA": "Aplicação",
    "CX": "Caixa",
}

# Income-statement lines in report order, as
# (row in the actuals sheet, row in the budget sheet, label, section, level).
STATEMENT_LINES = (
    (26, 26, "Receita Bruta", "receita", 0),
    (27, None, "SK", "receita", 2),
    (28, 29, "BK", "receita", 2),
    (29, 30, "RT", "receita", 2),
    (30, None, "Aditivo", "receita", 2),
    (None, 32, "Vendas RP", "receita", 2),
    (35, 35, "Impostos", "impostos", 0),
    (37, 37, "ICMS", "impostos", 2),
    (38, 38, "Crédito de ICMS", "impostos", 2),
    (39, 39, "ISS", "impostos", 2),
    (40, 40, "PIS/COFINS", "impostos", 2),
    (42, 42, "Receita Líquida", "receita_liq", 0),
    (44, 44, "Custos Operacionais", "custos", 0),
    (45, 45, "Comissões Externas", "custos", 2),
    (47, 46, "Comissões Internas", "custos", 2),
    (48, 47, "Obras (Total)", "custos", 1),
    (73, 71, "Margem de Contribuição", "margem", 0),
    (76, 74, "Despesas Gerais e Adm", "sga", 0),
    (78, 76, "Salários e Encargos", "sga", 1),
    (92, 90, "Despesas Administrativas", "sga", 1),
    (116, 113, "Despesas Comerciais", "sga", 1),
    (121, 117, "Despesas com Imóvel", "sga", 1),
    (131, 127, "Despesas com Veículos", "sga", 1),
    (137, 133, "Despesas com Diretoria", "sga", 1),
    (145, 141, "EBITDA", "ebitda", 0),
    (148, 144, "Receitas/Despesas Financeiras", "financeiro", 1),
    (163, 159, "IRPJ/CSLL", "impostos_renda", 0),
    (168, 164, "Lucro Líquido", "ll", 0),
)

GROSS_REVENUE = "Receita Bruta"
NET_PROFIT = "Lucro Líquido"

# Lines of the budget reports, in display order.
WATERFALL_LINES = (
    "Receita Bruta",
    "Impostos",
    "Custos Operacionais",
    "Despesas Gerais e Adm",
    "Receitas/Despesas Financeiras",
    "IRPJ/CSLL",
)
ATTAINMENT_LINES = (
    "Receita Bruta",
    "Receita Líquida",
    "Custos Operacionais",
    "Margem de Contribuição",
    "Despesas Gerais e Adm",
    "EBITDA",
    "Lucro Líquido",
)
MINI_STATEMENT_LINES = (
    "Receita Bruta",
    "Custos Operacionais",
    "Despesas Gerais e Adm",
    "EBITDA",
    "Lucro Líquido",
)

# Payroll summary sheet, row -> (key, label).
PAYROLL_RUBRICS = {
    4: ("salarios", "Salário Base"),
    5: ("softwares", "Softwares"),
    6: ("beneficios", "Benefícios"),
    7: ("comissao", "Comissão"),
    8: ("rescisao", "Rescisão"),
    9: ("bonus", "Bônus"),
    10: ("impostos", "Impostos/Encargos"),
    11: ("treinamentos", "Treinamentos"),
    12: ("decimo_terceiro", "13º Salário"),
}
PAYROLL_CASH_RUBRICS = {
    4: ("salarios", "Salários"),
    5: ("caju", "Caju"),
    6: ("vale_transporte", "VT"),
    7: ("inss_fgts", "INSS/FGTS"),
    8: ("clinica", "Clínica"),
    9: ("gympass", "Gympass"),
    10: ("estacionamento", "Estac."),
    11: ("rescisao", "Rescisão"),
    12: ("comissao", "Comissão"),
}
PAYROLL_TOTAL_ROW = 13
HEADCOUNT_ROWS = {
    15: "inicio",
    16: "saida_vol",
    17: "saida_inv",
    18: "admissoes",
    19: "final",
    20: "turnover",
}
AREA_ROWS = (23, 31)
AREA_TOTAL_LABEL = "CUSTO TOTAL"

# Role word -> seniority level, first match wins.
LEVEL_RULES = (
    ("gerente", "Gerência"),
    ("coordenador", "Coordenação"),
    ("analista|arquiteto|comprador|orçamentista|controller|fiscal", "Analista/Especialista"),
    ("assistente|auxiliar|almoxarife", "Assistente/Operacional"),
)
DEFAULT_LEVEL = "Analista/Especialista"

# Monthly deltas of the payroll scenarios.
SCENARIO_EXPANSION = 16000
SCENARIO_REDUCTION = 23000
SCENARIO_ONE_OFF = 30000

# Words that never name a company or a project.
STOPWORDS = tuple(
    """
    quanto quero qual quais como para pagar paguei pagou pago receber recebi
    recebeu faturou faturamos faturei devo devemos total valor traga trazer
    mostrar mostra buscar listar lista preciso mês mes março marco fevereiro
    janeiro abril maio junho julho agosto setembro outubro novembro dezembro
    esse esta este nesse neste dessa desse ontem hoje semana contas conta saldo
    projeto projetos cliente clientes fornecedor fornecedores todos todas mais
    menos entre sobre lançamentos lancamentos lançamento lancamento relação
    relacao emissão emissao data vencimento pagamento recebimento recebimentos
    entradas saídas saidas receita receitas despesa despesas custo custos nota
    notas fiscal banco bancos saldos categoria categorias grupo grupos margem
    previstos previsto previsão previsao pendente pendentes aberto abertos
    vencido vencidos atrasado atrasados quem são sao será sera pode poderia
    gostaria sendo feito fazer uma quantidade valores listagem extrato balanço
    balanco faturamento informações informacoes dados últimos ultimos
    """.split()
)

# Read-only audit of logged queries.
BANNED_SQL_WORDS = ("INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "TRUNCATE", "MERGE")
RESTRICTED_TABLES = ("folha_funcionarios", "saldos_bancarios")

HISTORY_RETENTION_MONTHS = 13
MAX_ERROR_CHARS = 4000
