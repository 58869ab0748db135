"""Finance inputs derived from the given star-schema tables.

Orders play receivables, line items payables, customers clients and bank
accounts, suppliers creditors, parts categories and payroll lines, events
balance snapshots and run logs. Every input covers its whole table. Lookups are
left joins, added only where a query needs their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import cents
from ledgerline.functions.text import pick
from ledgerline.operators import maintenance, normalize
from ledgerline.operators.budget import ACTUAL_SHEET, BUDGET_SHEET
from ledgerline.operators.payroll import SUMMARY_SHEET

AS_OF = "2000-01-01"
PERIOD = ("1999-07-01", "2000-07-01")
PAYROLL_AS_OF = "1999-07-15"
EVENTS_NOW = "2024-01-31 12:00:00"
IGNORED = (24,)
SUPPLIER_BASE = 1_000_000_000

PART_CODES = {
    "ECONOMY": "2.01.01",
    "STANDARD": "2.02.01",
    "MEDIUM": "2.03.01",
    "SMALL": "2.04.01",
    "LARGE": "2.10.01",
    "PROMO": "2.05.01",
}
# part type -> (statement line, section, level, budget factor in percent)
PART_LINES = {
    "ECONOMY": ("Receita Bruta", "receita", 0, 95),
    "STANDARD": ("Impostos", "impostos", 1, 120),
    "MEDIUM": ("Custos Operacionais", "custos", 0, 90),
    "SMALL": ("Despesas Gerais e Adm", "sga", 0, 150),
    "LARGE": ("EBITDA", "ebitda", 0, 80),
    "PROMO": ("Lucro Líquido", "ll", 0, 100),
}


# Explicit schemas: reading a footer for inference would start a job per table.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _day(c: str) -> Column:
    return F.to_date(F.col(c))


# --- ledger ------------------------------------------------------------------


def ledger(spark: SparkSession, sf: str, *need: str) -> DataFrame:
    """Ledger rows. ``need``: any of category, direct, project, client, account adds those columns."""
    wanted = set(need)
    rows = _inflow(spark, sf, wanted).unionByName(_outflow(spark, sf, wanted))
    extra = {"data_previsao": D.next_workday("data_vencimento")}
    if "direct" in wanted:
        extra["modalidade"] = T.modality("is_faturamento_direto")
    if "project" in wanted:
        extra["projeto_nome"] = project_name(F.col("projeto_id"))
    return rows.withColumns(extra)


def project_name(pid: Column) -> Column:
    text = pid.cast("string")
    return (
        F.when(pid.isNull(), K.NO_PROJECT)
        .when(pid % 7 == 0, F.concat(F.lit("SK Projeto "), text))
        .otherwise(F.concat(F.lit("Projeto "), text))
    )


SEGMENT = "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Faturamento Direto' ELSE c_mktsegment END"


def _inflow(spark: SparkSession, sf: str, need: set[str]) -> DataFrame:
    o = table(spark, sf, "orders")
    if need & {"category", "direct", "client", "account"}:
        c = table(spark, sf, "customer")
        o = o.join(c, o.o_custkey == c.c_custkey, "left")
    cols = [
        "o_orderkey AS id",
        "'entrada' AS tipo",
        "o_totalprice AS valor",
        "CASE o_orderstatus WHEN 'F' THEN 'RECEBIDO' WHEN 'O' THEN 'A VENCER' WHEN 'P' THEN 'ATRASADO' END AS status",
        "to_date(o_orderdate) AS data_emissao",
        "date_add(to_date(o_orderdate), 30) AS data_vencimento",
        "CASE WHEN o_orderstatus = 'F' THEN date_add(to_date(o_orderdate), int(o_orderkey % 150)) END AS data_pagamento",
        "string(o_orderkey) AS numero_documento",
    ]
    if "category" in need:
        cols += ["concat('1.01.0', left(o_orderpriority, 1)) AS categoria_codigo", f"{SEGMENT} AS categoria_nome"]
    if "direct" in need:
        cols.append(f"{SEGMENT} AS _direct")
    if "project" in need:
        cols.append("nullif(o_custkey % 500, 0) AS projeto_id")
    if "client" in need:
        cols += ["o_custkey AS cliente_id", "coalesce(c_name, '') AS cliente_nome"]
    if "account" in need:
        cols.append("bigint(c_nationkey) AS conta_corrente_id")
    return _direct(o.selectExpr(*cols), T.is_direct_inflow)


DOCUMENT = """CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN concat('FD NF ', l_orderkey)
 ELSE concat(l_orderkey, '/', l_linenumber) END"""


def _outflow(spark: SparkSession, sf: str, need: set[str]) -> DataFrame:
    li = table(spark, sf, "lineitem")
    if "project" in need:
        o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
        li = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    if "category" in need:
        p = table(spark, sf, "part").select("p_partkey", "p_type")
        li = li.join(p, li.l_partkey == p.p_partkey, "left")
    if need & {"client", "account"}:
        s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        li = li.join(s, li.l_suppkey == s.s_suppkey, "left")
    cols = [
        "bigint(NULL) AS id",
        "'saida' AS tipo",
        "l_extendedprice AS valor",
        """CASE WHEN l_linestatus = 'F' THEN 'PAGO' WHEN l_returnflag = 'R' THEN 'ATRASADO'
 WHEN l_returnflag = 'A' THEN 'A VENCER' WHEN l_returnflag = 'N' THEN 'VENCE HOJE' END AS status""",
        "to_date(l_shipdate) AS data_emissao",
        "date_add(to_date(l_shipdate), 45) AS data_vencimento",
        "CASE WHEN l_linestatus = 'F' THEN date_add(to_date(l_shipdate), int(l_orderkey % 150)) END AS data_pagamento",
        f"{DOCUMENT} AS numero_documento",
    ]
    if "category" in need:
        codes = " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in PART_CODES.items())
        cols += [f"CASE p_type {codes} END AS categoria_codigo", "p_type AS categoria_nome"]
    if "direct" in need:
        cols.append(f"{DOCUMENT} AS _direct")
    if "project" in need:
        cols.append("nullif(o_custkey % 500, 0) AS projeto_id")
    if "client" in need:
        cols += [f"l_suppkey + {SUPPLIER_BASE} AS cliente_id", "coalesce(s_name, '') AS cliente_nome"]
    if "account" in need:
        cols.append("bigint(s_nationkey) AS conta_corrente_id")
    return _direct(li.selectExpr(*cols), T.is_direct_outflow)


def _direct(rows: DataFrame, rule) -> DataFrame:
    """The billing rule of the side on its name or document number."""
    if "_direct" not in rows.columns:
        return rows
    at = rows.columns.index("_direct")
    kept = [F.col(c) for c in rows.columns]
    kept[at] = rule("_direct").alias("is_faturamento_direto")
    return rows.select(*kept)


# --- landed records ----------------------------------------------------------


def raw_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf categories and groups with code prefixes; two groups are unusable."""
    leaf = table(spark, sf, "part").select(pick("p_type", PART_CODES).alias("codigo"), F.col("p_type").alias("_n")).distinct()
    group = leaf.select(T.category_group("codigo").alias("codigo")).distinct()
    name = (
        F.when(F.col("codigo") == "2.05", K.UNAVAILABLE_CATEGORY)
        .when(F.col("codigo") == "2.10", F.lit(""))
        .otherwise(F.concat(F.col("codigo"), F.lit(" - Grupo "), F.col("codigo")))
    )
    return leaf.select("codigo", F.concat(F.col("codigo"), F.lit(" - "), F.col("_n")).alias("descricao")).unionByName(
        group.select("codigo", name.alias("descricao"))
    )


def categories(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.clean_categories(raw_categories(spark, sf))


def inflow_categories(spark: SparkSession, sf: str) -> DataFrame:
    """The one named category of inflow titles: direct billing."""
    used = table(spark, sf, "orders").select(F.concat(F.lit("1.01.0"), F.substring("o_orderpriority", 1, 1)).alias("codigo"))
    direct = used.filter(F.col("codigo") == "1.01.03").distinct()
    return direct.select("codigo", F.concat(F.col("codigo"), F.lit(" - Faturamento Direto")).alias("descricao"))


def landed_twice(raw: DataFrame, name: str, old: str) -> DataFrame:
    """Every record on page 2 and, with an old name, on page 1: pages shift while they are fetched."""
    page = lambda df, n: df.withColumns({"_page": F.lit(n).cast("long"), "_pos": F.lit(0)})
    return page(raw, 2).unionByName(page(raw.withColumn(name, F.lit(old)), 1))


def raw_receivables(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    day = _day("o_orderdate")
    key = F.col("o_orderkey")
    br = lambda d: F.date_format(d, "dd/MM/yyyy")
    due = F.date_add(day, 30)
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        key.alias("codigo_lancamento"),
        F.col("o_totalprice").alias("valor_documento"),
        pick("o_orderstatus", {"F": "Recebido", "O": "A Vencer", "P": "Atrasado"}).alias("status_titulo"),
        F.when(key % 97 == 0, F.lit("abc")).otherwise(br(due)).alias("data_vencimento"),
        br(day).alias("data_emissao"),
        F.when(key % 10 == 0, F.lit("")).otherwise(br(D.next_workday(due))).alias("data_previsao"),
        key.cast("string").alias("numero_documento"),
        F.concat(F.lit("1.01.0"), F.substring("o_orderpriority", 1, 1)).alias("codigo_categoria"),
        (F.col("o_custkey") % 500).alias("codigo_projeto"),
        F.col("o_custkey").alias("codigo_cliente_fornecedor"),
        F.col("c_nationkey").cast("long").alias("id_conta_corrente"),
    )


def raw_payables(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    day = _day("l_shipdate")
    due = F.date_add(day, 45)
    br = lambda d: F.date_format(d, "dd/MM/yyyy")
    order = F.col("l_orderkey").cast("string")
    plain = F.concat_ws("/", order, F.col("l_linenumber").cast("string"))
    flag, n = F.col("l_returnflag"), F.col("l_linenumber")
    status = F.when(F.col("l_linestatus") == "F", "Pago").otherwise(
        pick("l_returnflag", {"R": "Atrasado", "A": "A Vencer", "N": "Vence Hoje"})
    )
    return (
        li.join(p, li.l_partkey == p.p_partkey, "left")
        .join(s, li.l_suppkey == s.s_suppkey, "left")
        .select(
            (-(F.col("l_orderkey") * 10 + n)).alias("codigo_lancamento"),
            F.col("l_extendedprice").alias("valor_documento"),
            status.alias("status_titulo"),
            br(due).alias("data_vencimento"),
            br(day).alias("data_emissao"),
            br(D.next_workday(due)).alias("data_previsao"),
            F.when((flag == "N") & (n == 1), F.concat(F.lit("FD NF "), order)).otherwise(plain).alias("numero_documento"),
            F.when((flag == "A") & (n == 2), F.concat(F.lit("fd "), order)).alias("numero_documento_fiscal"),
            pick("p_type", PART_CODES).alias("codigo_categoria"),
            F.lit(None).cast("long").alias("codigo_projeto"),
            (F.col("l_suppkey") + SUPPLIER_BASE).alias("codigo_cliente_fornecedor"),
            F.col("s_nationkey").cast("long").alias("id_conta_corrente"),
        )
    )


def raw_movements(spark: SparkSession, sf: str) -> DataFrame:
    """Payments of received orders: an earlier duplicate, an unreadable later one, and some that are all unreadable."""
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    key = F.col("o_orderkey")
    paid = F.date_add(_day("o_orderdate"), (key % 150).cast("int"))
    br = lambda d: F.when(key % 17 == 0, F.lit("abc")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    seen = F.array_compact(
        F.array(
            F.when(key % 11 == 0, F.struct(F.lit(1).alias("_page"), br(F.date_sub(paid, 3)).alias("d"))),
            F.struct(F.lit(2).alias("_page"), br(paid).alias("d")),
            F.when(key % 13 == 0, F.struct(F.lit(3).alias("_page"), F.lit("abc").alias("d"))),
        )
    )
    return o.select(key, F.explode(seen).alias("m")).select(
        F.struct(key.alias("nCodTitulo"), F.col("m.d").alias("dDtPagamento")).alias("detalhes"),
        F.col("m._page").cast("long").alias("_page"),
        (key % 500).cast("int").alias("_pos"),
    )


def raw_projects(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "customer").select((F.col("c_custkey") % 500).alias("codigo")).distinct()
    pid = F.col("codigo")
    return ids.select("codigo", F.when(pid % 50 == 0, F.lit("")).otherwise(project_name(pid)).alias("nome"))


def raw_clients(spark: SparkSession, sf: str, suppliers: bool = False) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("_first"))
    key = F.col("c_custkey")
    rows = (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(first, c.c_custkey == first.o_custkey, "left")
        .select(
            key.alias("codigo_cliente"),
            F.when(key % 5 == 0, F.lit("")).otherwise(F.col("c_name")).alias("nome_fantasia"),
            F.when(key % 25 != 0, F.concat(F.col("c_name"), F.lit(" SA"))).alias("razao_social"),
            F.when(F.col("c_nationkey") == 3, F.lit("")).otherwise(F.col("n_name")).alias("estado"),
            F.when(F.col("c_acctbal") < 0, F.lit("S")).when(key % 2 == 0, F.lit("N")).alias("inativo"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("S")).alias("pessoa_fisica"),
            F.struct(F.date_format("_first", "dd/MM/yyyy HH:mm").alias("dInc")).alias("info"),
        )
    )
    if not suppliers:
        return rows
    s = table(spark, sf, "supplier")
    return rows.unionByName(
        s.select(
            (F.col("s_suppkey") + SUPPLIER_BASE).alias("codigo_cliente"),
            F.col("s_name").alias("nome_fantasia"),
            F.lit(None).cast("string").alias("razao_social"),
            F.lit("").alias("estado"),
            F.lit("N").alias("inativo"),
            F.lit("N").alias("pessoa_fisica"),
            F.struct(F.lit(None).cast("string").alias("dInc")).alias("info"),
        )
    )


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Sales orders in their nested landed shape: one record per order with all its items.

    Even lines come with a second item, a free sample. A landed order is one JSON record, so
    its items are few enough for one row.
    """
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    key = F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1)
    stage = F.when(digit == "5", F.lit("95")).otherwise(F.concat(digit, F.lit("0")))
    item = lambda quantity, value: F.struct(
        F.struct(F.col("p_name").alias("descricao"), quantity.alias("quantidade"), value.alias("valor_total")).alias("produto")
    )
    sold = item(F.col("l_quantity"), F.col("l_extendedprice"))
    one = F.when(F.col("l_linenumber") % 2 == 0, F.array(sold, item(F.lit(1.0), F.lit(0.0)))).otherwise(F.array(sold))
    lines = li.join(p, F.col("l_partkey") == p.p_partkey, "left").groupBy("l_orderkey").agg(F.flatten(F.collect_list(one)).alias("det"))
    return o.join(lines, key == F.col("l_orderkey"), "left").select(
        F.struct(
            key.alias("codigo_pedido"),
            stage.alias("etapa"),
            F.when(key % 29 != 0, F.date_format("o_orderdate", "dd/MM/yyyy")).alias("data_previsao"),
        ).alias("cabecalho"),
        F.struct(F.col("o_totalprice").alias("valor_mercadorias")).alias("total_pedido"),
        "det",
    )


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.order_items(raw_orders(spark, sf))


def clients(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.clean_clients(raw_clients(spark, sf))


# --- balances and history ----------------------------------------------------


def raw_accounts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    types = {0: "CC", 1: "CR", 2: "CG", 3: "CA", 4: "CX", 5: "ZZ"}
    code = pick((F.col("c_custkey") % 6).cast("int"), types)
    return c.select(
        F.col("c_custkey").alias("nCodCC"),
        F.col("c_name").alias("descricao"),
        F.when(F.col("c_custkey") % 10 != 0, code).alias("cCodTipo"),
        code.alias("tipo"),
    )


def raw_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Fetched balances; those of every 43rd account are missing."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    idle = key % 41 == 0
    shift = F.when(key % 3 == 0, F.lit(10.5)).otherwise(F.lit(0.0))
    known = key % 43 != 0
    return c.select(
        key.alias("conta_id"),
        F.when(known, F.when(idle, F.lit(0.0)).otherwise(F.col("c_acctbal"))).alias("saldo"),
        F.when(known, F.when(idle, F.lit(0.0)).otherwise(F.round(F.col("c_acctbal") - shift, 2))).alias("saldo_conciliado"),
    )


def balances(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.account_balances(
        raw_accounts(spark, sf), raw_statements(spark, sf), F.date_sub(D.date_lit(AS_OF), 1), IGNORED
    )


def event_history(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("conta_id"),
        F.concat(F.lit("Conta "), F.col("user_id").cast("string")).alias("conta_nome"),
        _day("ts").alias("data_referencia"),
        F.col("event_type").alias("tipo"),
        F.col("value").alias("saldo_atual"),
        F.col("ts").alias("sync_timestamp"),
        F.col("event_id").alias("evento"),
        _day("ts").alias("sync_date"),
    )


def balance_history(spark: SparkSession, sf: str) -> DataFrame:
    """Month-end snapshots per account, several per key."""
    account = F.col("o_custkey") % 25
    return table(spark, sf, "orders").select(
        account.alias("conta_id"),
        F.concat(F.lit("Conta "), account.cast("string")).alias("conta_nome"),
        F.last_day(_day("o_orderdate")).alias("data_referencia"),
        F.lit("mensal").alias("tipo"),
        F.col("o_totalprice").alias("saldo_atual"),
        F.col("o_orderdate").alias("sync_timestamp"),
        F.col("o_orderkey").alias("pedido"),
        _day("o_orderdate").alias("sync_date"),
    )


def latest_balances(spark: SparkSession, sf: str) -> DataFrame:
    return maintenance.latest_history(balance_history(spark, sf), newest=("sync_timestamp", "pedido"))


def merge_target(spark: SparkSession, sf: str) -> DataFrame:
    """Every order; a tenth has an id that the source doesn't know (deletes)."""
    return table(spark, sf, "orders").select(*_merge_columns(0))


def merge_source(spark: SparkSession, sf: str) -> DataFrame:
    """Every order; a tenth has an id that the target doesn't know (inserts). Dates change too, but are not compared."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    o = o.withColumn("o_totalprice", F.when(key % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    o = o.withColumn("o_orderpriority", F.when(key % 13 != 0, F.col("o_orderpriority")))
    o = o.withColumn("o_orderdate", F.when(key % 11 == 0, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate")))
    return o.select(*_merge_columns(1))


def _merge_columns(renumbered: int) -> list[Column]:
    key = F.col("o_orderkey")
    return [
        F.when(key % 10 == renumbered, -key).otherwise(key).alias("id"),
        F.col("o_totalprice").alias("valor"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("prioridade"),
        _day("o_orderdate").alias("data_emissao"),
    ]


MERGE_COMPARE = ("valor", "status", "prioridade")


# --- budget ------------------------------------------------------------------


def _line_facts(spark: SparkSession, sf: str, key: Column) -> DataFrame:
    """Net actual (1/100 cents) and gross cents per part type and month key."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_discount", "l_shipdate")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    gross = cents("l_extendedprice")
    net = gross * (100 - cents("l_discount"))
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    return j.groupBy("p_type", key.alias("k")).agg(F.sum(net).alias("net"), F.sum(gross).alias("gross"))


def _amounts() -> tuple[Column, Column]:
    factor = pick("p_type", {t: v[3] for t, v in PART_LINES.items()})
    real = F.expr("(net + 50) div 100") / 100.0
    bp = F.floor((F.col("gross") * factor + 50) / 100) / 100.0
    return real, bp


def budget(spark: SparkSession, sf: str) -> DataFrame:
    facts = _line_facts(spark, sf, F.trunc(_day("l_shipdate"), "month"))
    line = lambda i: pick("p_type", {t: v[i] for t, v in PART_LINES.items()})
    real, bp = _amounts()
    mes = D.month_text("k")
    no_budget = (F.col("p_type") == "PROMO") & (F.month("k") == 2)
    return facts.select(
        line(0).alias("label"),
        line(1).alias("section"),
        line(2).cast("long").alias("level"),
        mes.alias("mes"),
        real.alias("valor_real"),
        F.when(no_budget, F.lit(0.0)).otherwise(bp).alias("valor_bp"),
        (mes < AS_OF[:7]).alias("mes_com_real"),
    )


def ledger_months() -> list[str]:
    """Months in which ledger rows can fall: payments come up to 150 days after the last order."""
    return [f"{y}-{m:02d}" for y in range(1995, 2003) for m in range(1, 13)]


def budget_months() -> list[str]:
    return [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


def budget_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Workbook grid: calendar-month totals over all years, label cells, one unreadable and some empty cells."""
    facts = _line_facts(spark, sf, F.month("l_shipdate"))
    rows = {line[2]: line for line in K.STATEMENT_LINES}
    real, bp = _amounts()
    row = lambda i: pick("p_type", {t: rows[v[0]][i] for t, v in PART_LINES.items()})
    money = lambda c: F.format_string("%.2f", c)
    line = pick("p_type", {t: v[0] for t, v in PART_LINES.items()})
    unreadable = (line == "EBITDA") & (F.col("k") == 5)
    empty = (line == K.GROSS_REVENUE) & (F.col("k") >= 10)
    cell = lambda sheet, r, col, v: F.struct(
        F.lit(sheet).alias("sheet"), r.cast("int").alias("row"), col.cast("int").alias("col"), v.alias("value")
    )
    values = facts.select(
        F.explode(
            F.array(
                cell(ACTUAL_SHEET, row(0), F.col("k") + 3, F.when(unreadable, F.lit("n/d")).when(~empty, money(real))),
                cell(BUDGET_SHEET, row(1), F.col("k") + 3, money(bp)),
            )
        ).alias("c")
    ).select("c.*")
    types = table(spark, sf, "part").select("p_type").distinct()
    name = F.when(F.col("p_type") == "MEDIUM", F.lit("Outra linha")).otherwise(F.lower(line))
    labels = types.select(
        F.explode(
            F.array(cell(ACTUAL_SHEET, row(0), F.lit(2), name), cell(BUDGET_SHEET, row(1), F.lit(3), F.concat(name, F.lit(" total "))))
        ).alias("c")
    ).select("c.*")
    return values.unionByName(labels)


# --- payroll -----------------------------------------------------------------


def payroll_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Month sheets as text: persons, total rows, department subtotals, unreadable values."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    brand = F.col("p_brand")
    subtotal = (k % 51 == 0) | (k % 53 == 0)
    text = lambda c: c.cast("string")
    name = (
        F.when(k % 50 == 0, F.lit(" Totais "))
        .when(k % 51 == 0, F.upper(brand))
        .when(k % 53 == 0, F.lit("COMERCIAL"))
        .when(k % 59 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("Func "), text(k)))
    )
    salary = F.when(k % 23 == 0, F.lit("0")).when(k % 29 == 0, F.lit("n/d")).otherwise(text(F.col("p_retailprice")))
    size = F.col("p_size")
    return p.select(
        F.format_string("1999-%02d", (k % 12 + 1).cast("int")).alias("mes"),
        name.alias("nome"),
        brand.alias("departamento"),
        F.when(~subtotal, F.col("p_name")).alias("cargo"),
        F.when(k % 4 != 0, F.lit("1998-05-04")).otherwise(F.lit("04/05/1998")).alias("data_admissao"),
        F.when(k % 31 == 0, F.lit("x")).when(k % 37 == 0, F.lit("0")).otherwise(text(size)).alias("idade"),
        F.when(k % 9 != 0, text(k % 120)).alias("tempo_casa"),
        salary.alias("salario"),
        text(size).alias("comissao"),
        text(size * 2).alias("bonus"),
        F.when(k % 19 == 0, F.lit("100.5")).alias("rescisao"),
        F.lit("10.5").alias("caju"),
        text(size).alias("vt"),
        F.lit(None).cast("string").alias("estac"),
        F.lit("5").alias("clinica"),
        F.lit("1.25").alias("gympass"),
        text(F.round(F.col("p_retailprice") + 200, 2)).alias("custo_total"),
    )


LEVEL_RULES = (
    ("WIDGET", "Gerência"),
    ("bolt", "Coordenação"),
    ("ring|gear|rod", "Analista/Especialista"),
    ("plate|anvil", "Assistente/Operacional"),
)


def payroll_cells(spark: SparkSession, sf: str, *parts: str, sheet: str = SUMMARY_SHEET) -> DataFrame:
    """Summary sheet cells; ``parts``: rubrics, areas, headcount. Two months and one rubric are empty."""
    out: DataFrame | None = None
    for part in parts:
        cells = {"rubrics": _rubric_cells, "areas": _area_cells, "headcount": _headcount_cells}[part](spark, sf)
        out = cells if out is None else out.unionByName(cells)
    return out.select(F.lit(sheet).alias("sheet"), "row", "col", "value")


def _cost_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line by its column; those of September and November are booked a month later."""
    li = table(spark, sf, "lineitem")
    m = F.month("l_shipdate")
    booked = F.when(m.isin(*EMPTY_MONTHS), m + 1).otherwise(m)
    return li.select((booked + 1).alias("col"), "l_linenumber", "l_suppkey", cents("l_extendedprice").alias("c"))


def _money_text(c: str) -> Column:
    return F.format_string("%.2f", F.col(c) / 100.0)


EMPTY_MONTHS = (9, 11)
EMPTY_RUBRIC = 7  # its lines are booked on the next one


def _empty_cells(cells: DataFrame, months: range | tuple[int, ...]) -> DataFrame:
    """Cells without a value in the given rows (column ``row``) for some months."""
    cols = F.array(*[F.lit(m + 1) for m in months])
    return cells.select("row").distinct().select("row", F.explode(cols).alias("col"), F.lit("").alias("value"))


def _rubric_cells(spark: SparkSession, sf: str) -> DataFrame:
    rubric = F.col("l_suppkey") % 9
    row = (F.when(rubric == EMPTY_RUBRIC, rubric + 1).otherwise(rubric) + 4).cast("int")
    g = _cost_lines(spark, sf).rollup("col", row.alias("row")).agg(F.sum("c").alias("c")).filter("col IS NOT NULL")
    values = g.select(F.coalesce("row", F.lit(K.PAYROLL_TOTAL_ROW)).alias("row"), "col", _money_text("c").alias("value"))
    rows = spark.range(4, K.PAYROLL_TOTAL_ROW + 1).select(F.col("id").cast("int").alias("row"))
    empty = _empty_cells(rows, EMPTY_MONTHS).unionByName(_empty_cells(rows.filter(F.col("row") == EMPTY_RUBRIC + 4), range(1, 13)))
    return values.unionByName(empty)


def _area_cells(spark: SparkSession, sf: str) -> DataFrame:
    lines = _cost_lines(spark, sf)
    row = (F.col("l_linenumber") + 22).cast("int")
    g = lines.rollup("col", row.alias("row")).agg(F.sum("c").alias("c")).filter("col IS NOT NULL")
    row_of = F.coalesce("row", F.lit(30))
    name = F.when(row_of == 30, K.AREA_TOTAL_LABEL).otherwise(F.concat(F.lit("Area "), (row_of - 22).cast("string")))
    cell = lambda col, v: F.struct(row_of.alias("row"), col.alias("col"), v.alias("value"))
    both = F.array(cell(F.col("col"), _money_text("c")), cell(F.lit(1), name))
    values = g.select(F.explode(both).alias("x")).select("x.*").distinct()
    rows = spark.range(23, 31).select(F.col("id").cast("int").alias("row"))
    return values.unionByName(_empty_cells(rows, EMPTY_MONTHS))


def _headcount_cells(spark: SparkSession, sf: str) -> DataFrame:
    s, urgent = F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT"
    g = (
        table(spark, sf, "orders")
        .groupBy((F.month("o_orderdate") + 1).alias("col"))
        .agg(
            F.count(F.lit(1)).alias("ini"),
            F.count_if(s == "P").alias("vol"),
            F.count_if((s == "O") & urgent).alias("inv"),
            F.count_if(s == "F").alias("adm"),
        )
    )
    c = F.col
    value = lambda row, v: F.struct(F.lit(row).alias("row"), v.cast("string").alias("value"))
    cells = F.array(
        value(15, c("ini")),
        value(16, c("vol")),
        value(17, c("inv")),
        value(18, c("adm")),
        value(19, c("ini") + c("adm") - c("vol") - c("inv")),
        value(20, F.floor((c("vol") + c("inv")) * 10000 / c("ini")) / 10000.0),
    )
    return g.select("col", F.explode(cells).alias("x")).select("x.row", "col", "x.value")


def headcount_history(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes_num"))
        .agg(F.count(F.lit(1)).alias("hc"))
    )


def nation_months(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue cells nation x month; some cells are absent."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    g = (
        o.join(c, o.o_custkey == c.c_custkey, "left")
        .groupBy("c_nationkey", D.month_start(_day("o_orderdate")).alias("_m"))
        .agg((F.sum(cents("o_totalprice")) / 100.0).alias("valor"))
    )
    return g.select(F.col("c_nationkey").alias("nacao"), D.month_text("_m").alias("mes"), "valor")


# --- run log, names, query log -----------------------------------------------


def sync_log(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "running").otherwise("success")
    end = F.col("ts") + F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))
    return e.select(
        F.col("event_id").cast("string").alias("sync_id"),
        F.col("ts").alias("started_at"),
        F.when(F.col("event_type") != "view", end).alias("finished_at"),
        status.alias("status"),
    )


def names(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.col("p_name").alias("nome")).distinct()
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("nome")).distinct()
    return p.withColumn("tipo", F.lit("projeto")).unionByName(s.withColumn("tipo", F.lit("cliente")))


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every user turn as a question: both words of a part, words of two parts, a supplier, or the turn's own text."""
    turns = table(spark, sf, "conversations").filter("role = 'user'").select("conv_id", "turn", "text")
    at = lambda step: (F.col("conv_id") * step + F.col("turn")) % 200
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    named = turns.join(parts.select(F.col("p_partkey").alias("a"), F.col("p_name").alias("x")), at(31) == F.col("a")).join(
        parts.select(F.col("p_partkey").alias("b"), F.col("p_name").alias("y")), at(17) == F.col("b")
    )
    kind = (F.col("conv_id") + F.col("turn")) % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("Quanto "), F.upper("x"), F.lit("?")))
        .when(kind == 1, F.concat(F.split("x", " ")[0], F.lit(" e a "), F.split("y", " ")[1], F.lit(" esse mês")))
        .when(kind == 2, F.concat(F.lit("Supplier "), F.lpad((F.col("conv_id") % 10).cast("string"), 9, "0")))
        .when(kind == 3, F.concat(F.lit("total de "), F.split("y", " ")[1]))
        .otherwise(F.col("text"))
    )
    return named.select(F.concat_ws(" ", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("pergunta"), text.alias("texto"))


QUERY_TEXTS = (
    "SELECT valor FROM fin.lancamentos WHERE id = ",
    "INSERT INTO fin.lancamentos VALUES ",
    "select 1 ;DROP TABLE fin.lancamentos -- ",
    "SELECT * FROM fin.folha_funcionarios WHERE mes = ",
    "SELECT * FROM other.lancamentos WHERE id = ",
    "select saldo from fin.saldos_bancarios where conta = ",
    "SELECT x FROM fin.t WHERE delete = ",
    " select nome from fin.projetos -- ",
)


def query_log(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    texts = F.array(*[F.lit(t) for t in QUERY_TEXTS])
    text = F.get(texts, (F.col("o_orderkey") % len(QUERY_TEXTS)).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("consulta"),
        F.concat(text, F.col("o_orderkey").cast("string")).alias("sql"),
        (F.col("o_custkey") % 2 == 0).alias("is_exec"),
    )
