"""Schemas of landed records and of the warehouse tables.

Nothing is inferred. ``TABLES`` is the contract of the stored tables: DDL with
comments, partition columns, the columns files are sorted on, and the key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RAW = {
    "receivables": """
        codigo_lancamento BIGINT, valor_documento DOUBLE, status_titulo STRING, data_vencimento STRING,
        data_emissao STRING, data_previsao STRING, numero_documento STRING, codigo_categoria STRING,
        codigo_projeto BIGINT, codigo_cliente_fornecedor BIGINT, id_conta_corrente BIGINT""",
    "payables": """
        codigo_lancamento BIGINT, valor_documento DOUBLE, status_titulo STRING, data_vencimento STRING,
        data_emissao STRING, data_previsao STRING, numero_documento STRING, numero_documento_fiscal STRING,
        codigo_categoria STRING, codigo_projeto BIGINT, codigo_cliente_fornecedor BIGINT,
        id_conta_corrente BIGINT""",
    "movements": "detalhes STRUCT<nCodTitulo: BIGINT, dDtPagamento: STRING>",
    "categories": "codigo STRING, descricao STRING",
    "projects": "codigo BIGINT, nome STRING",
    "clients": """
        codigo_cliente BIGINT, nome_fantasia STRING, razao_social STRING, estado STRING, inativo STRING,
        pessoa_fisica STRING, info STRUCT<dInc: STRING>""",
    "accounts": "nCodCC BIGINT, descricao STRING, cCodTipo STRING, tipo STRING",
    "orders": """
        cabecalho STRUCT<codigo_pedido: BIGINT, etapa: STRING, data_previsao: STRING>,
        total_pedido STRUCT<valor_mercadorias: DOUBLE>,
        det ARRAY<STRUCT<produto: STRUCT<descricao: STRING, quantidade: DOUBLE, valor_total: DOUBLE>>>""",
}


MONTH = "mes_particao"  # partition column of tables that are stored by month


@dataclass(frozen=True)
class Table:
    ddl: str
    about: str
    key: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    month: str | None = None  # rows are stored by the month of this date
    restricted: bool = False

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


SYNC = "sync_timestamp TIMESTAMP NOT NULL"
SYNC_DAY = SYNC + ", sync_date DATE NOT NULL"

TABLES = {
    "lancamentos": Table(
        f"""id BIGINT NOT NULL COMMENT 'title id', tipo STRING NOT NULL COMMENT 'entrada or saida',
        valor DOUBLE NOT NULL COMMENT 'document amount', status STRING COMMENT 'title status, upper case',
        data_vencimento DATE COMMENT 'due date', data_emissao DATE COMMENT 'issue date',
        data_pagamento DATE COMMENT 'date paid or received', data_previsao DATE COMMENT 'expected work day',
        numero_documento STRING COMMENT 'document number', categoria_codigo STRING COMMENT 'account code',
        categoria_nome STRING COMMENT 'category name', categoria_grupo STRING COMMENT 'first two code levels',
        projeto_id BIGINT, projeto_nome STRING, cliente_id BIGINT, cliente_nome STRING,
        conta_corrente_id BIGINT, is_faturamento_direto BOOLEAN COMMENT 'direct billing',
        modalidade STRING COMMENT 'SK or FD', {SYNC_DAY}""",
        "receivables and payables",
        key=("id",),
        sort=("tipo", "categoria_grupo"),
        month="data_vencimento",
    ),
    "saldos_bancarios": Table(
        f"""conta_id BIGINT NOT NULL, conta_nome STRING NOT NULL, conta_tipo STRING, saldo DOUBLE NOT NULL,
        saldo_conciliado DOUBLE NOT NULL, diferenca DOUBLE NOT NULL COMMENT 'saldo - saldo_conciliado',
        data_referencia DATE NOT NULL COMMENT 'previous day', {SYNC_DAY}""",
        "bank balances of the previous day",
        key=("conta_id",),
        partition=("sync_date",),
        restricted=True,
    ),
    "historico_saldos": Table(
        f"""conta_id BIGINT NOT NULL, conta_nome STRING NOT NULL, data_referencia DATE NOT NULL,
        label STRING COMMENT 'Jan/26 or 15/01', saldo_atual DOUBLE NOT NULL, saldo_conciliado DOUBLE NOT NULL,
        diferenca DOUBLE NOT NULL, tipo STRING NOT NULL COMMENT 'mensal or diario', {SYNC_DAY}""",
        "balance snapshots, appended by every run",
        key=("conta_id", "data_referencia", "tipo"),
        partition=("sync_date",),
        sort=("conta_id", "tipo"),
    ),
    "categorias": Table(
        f"codigo STRING NOT NULL, nome STRING NOT NULL, grupo STRING, {SYNC}", "categories", key=("codigo",)
    ),
    "projetos": Table(f"id BIGINT NOT NULL, nome STRING NOT NULL, {SYNC}", "projects", key=("id",)),
    "clientes": Table(
        f"""id BIGINT NOT NULL, nome_fantasia STRING, razao_social STRING, estado STRING, ativo BOOLEAN,
        pessoa_fisica BOOLEAN, data_cadastro DATE, {SYNC}""",
        "customers and suppliers",
        key=("id",),
    ),
    "vendas_pedidos": Table(
        f"""pedido_id BIGINT, valor_mercadorias DOUBLE NOT NULL, etapa STRING, data_previsao DATE,
        produto_descricao STRING, produto_quantidade DOUBLE, produto_valor_total DOUBLE, {SYNC_DAY}""",
        "sales orders, one row per item",
        partition=("sync_date",),
    ),
    "orcamento_dre": Table(
        f"""label STRING NOT NULL, section STRING NOT NULL, level BIGINT NOT NULL, mes STRING NOT NULL,
        valor_real DOUBLE, valor_bp DOUBLE, variacao_pct DOUBLE, mes_com_real BOOLEAN, {SYNC}""",
        "actuals against budget, one row per line and month",
        key=("label", "mes"),
    ),
    "sync_log": Table(
        """sync_id STRING NOT NULL, started_at TIMESTAMP NOT NULL, finished_at TIMESTAMP, status STRING NOT NULL,
        duration_seconds BIGINT, lancamentos_count BIGINT, saldos_count BIGINT, clientes_count BIGINT,
        projetos_count BIGINT, categorias_count BIGINT, error_message STRING, is_incremental BOOLEAN""",
        "run events",
    ),
    "folha_funcionarios": Table(
        """nome STRING NOT NULL, departamento STRING, cargo STRING, data_admissao DATE, idade BIGINT,
        tempo_casa_meses DOUBLE, salario DOUBLE, comissao DOUBLE, bonus DOUBLE, rescisao DOUBLE,
        beneficios DOUBLE, custo_total DOUBLE, mes_referencia STRING NOT NULL, status STRING""",
        "payroll rows",
        restricted=True,
    ),
}

# Compared and stored columns of the merged tables.
MERGE_RULES = {
    "lancamentos": (
        "valor", "status", "data_vencimento", "data_pagamento", "data_previsao", "modalidade",
        "categoria_codigo", "categoria_nome", "projeto_id", "projeto_nome", "cliente_nome",
    ),
    "categorias": ("nome", "grupo"),
    "projetos": ("nome",),
    "clientes": ("nome_fantasia", "razao_social", "estado", "ativo", "pessoa_fisica"),
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table].schema)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order with table types; missing columns become NULL."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].schema
        ]
    )


def null_violations(df: DataFrame, table: str) -> DataFrame:
    """Count of NULLs per NOT NULL column: Parquet does not enforce them on read."""
    from pyspark.sql import functions as F

    required = [f.name for f in TABLES[table].schema if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "coluna", "nulos")
