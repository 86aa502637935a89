"""Declared schemas, header dictionaries and length limits of the trip tables.

Nothing is inferred from data: raw tables are text, silver tables have the types below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# File names, CSV headers (stripped, lower case) and the columns they map to.
# They belong to the published data set and must be spelled exactly like this.
# ---------------------------------------------------------------------------------------

FILES = {
    "raw_viagem": "2025_Viagem.csv",
    "raw_passagem": "2025_Passagem.csv",
    "raw_pagamento": "2025_Pagamento.csv",
    "raw_trecho": "2025_Trecho.csv",
}

HEADERS = {
    "raw_viagem": {
        "identificador do processo de viagem": "id_viagem",
        "número da proposta (pcdp)": "num_proposta",
        "situação": "situacao",
        "viagem urgente": "viagem_urgente",
        "código do órgão superior": "cod_orgao_superior",
        "nome do órgão superior": "nome_orgao_superior",
        "cpf viajante": "cpf_viajante",
        "nome": "nome_viajante",
        "nome do viajante": "nome_viajante",
        "função": "funcao",
        "cargo": "cargo",
        "período - data de início": "data_inicio",
        "período - data de fim": "data_fim",
        "destinos": "destinos",
        "motivo": "motivo",
        "valor diárias": "valor_diarias",
        "valor passagens": "valor_passagens",
        "valor devolução": "valor_devolucao",
        "valor outros gastos": "valor_outros_gastos",
    },
    "raw_passagem": {
        "identificador do processo de viagem": "id_viagem",
        "meio de transporte": "meio_transporte",
        "país - origem ida": "pais_origem_ida",
        "uf - origem ida": "uf_origem_ida",
        "cidade - origem ida": "cidade_origem_ida",
        "país - destino ida": "pais_destino_ida",
        "uf - destino ida": "uf_destino_ida",
        "cidade - destino ida": "cidade_destino_ida",
        "valor da passagem": "valor_passagem",
        "taxa de serviço": "taxa_servico",
        "data da emissão/compra": "data_emissao",
        "dados de volta da passagem": "dados_volta_passagem",
    },
    "raw_pagamento": {
        "identificador do processo de viagem": "id_viagem",
        "número da proposta (pcdp)": "num_proposta",
        "nome do órgão pagador": "nome_orgao_pagador",
        "nome da unidade gestora pagadora": "nome_ug_pagadora",
        "tipo de pagamento": "tipo_pagamento",
        "valor": "valor",
    },
    "raw_trecho": {
        "identificador do processo de viagem": "id_viagem",
        "sequência trecho": "sequencia_trecho",
        "origem - data": "origem_data",
        "origem - uf": "origem_uf",
        "origem - cidade": "origem_cidade",
        "destino - data": "destino_data",
        "destino - uf": "destino_uf",
        "destino - cidade": "destino_cidade",
        "meio de transporte": "meio_transporte",
        "número diárias": "numero_diarias",
    },
}

# Tables whose rows get a generated 1..N id, stored as text in raw and as a long in silver.
GENERATED_IDS = {
    "raw_passagem": "id_passagem",
    "raw_pagamento": "id_pagamento",
    "raw_trecho": "id_trecho",
}

# Longest text a raw column holds; every column not named here holds 255.
RAW_LENGTH = 255
RAW_LENGTHS = {"destinos": 4000, "motivo": 4000}

# Text that a CSV field may hold for "no value" (the usual missing-value tokens of pandas).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Label of a blank category.
BLANK_LABEL = "Não Informado"

# Silver columns: "name type" or "name type max-length".
_SILVER = {
    "silver_viagem": """
        id_viagem string 20
        num_proposta string 20
        situacao string 50
        viagem_urgente string 5
        cod_orgao_superior string 20
        nome_orgao_superior string 255
        nome_viajante string 255
        cargo string 255
        data_inicio date
        data_fim date
        destinos string 4000
        motivo string 4000
        valor_diarias decimal(10,2)
        valor_passagens decimal(10,2)
        valor_devolucao decimal(10,2)
        valor_outros_gastos decimal(10,2)
        valor_total decimal(12,2)
        duracao_dias int
    """,
    "silver_passagem": """
        id_passagem long
        id_viagem string 20
        meio_transporte string 50
        pais_origem_ida string 60
        uf_origem_ida string 40
        cidade_origem_ida string 80
        pais_destino_ida string 60
        uf_destino_ida string 40
        cidade_destino_ida string 80
        valor_passagem decimal(10,2)
        taxa_servico decimal(10,2)
        data_emissao date
    """,
    "silver_pagamento": """
        id_pagamento long
        id_viagem string 20
        num_proposta string 20
        nome_orgao_pagador string 255
        nome_ug_pagadora string 255
        tipo_pagamento string 50
        valor decimal(10,2)
    """,
    "silver_trecho": """
        id_trecho long
        id_viagem string 20
        sequencia_trecho int
        origem_data date
        origem_uf string 40
        origem_cidade string 80
        destino_data date
        destino_uf string 40
        destino_cidade string 80
        meio_transporte string 50
        numero_diarias decimal(10,2)
    """,
}

# Columns that may not be NULL, and columns that may not be negative, per silver table.
NOT_NULL = {
    "silver_viagem": ["id_viagem", "nome_orgao_superior"],
    "silver_passagem": ["id_viagem"],
    "silver_pagamento": ["id_viagem", "tipo_pagamento"],
    "silver_trecho": ["id_viagem"],
}
NON_NEGATIVE = {
    "silver_viagem": ["valor_diarias"],
    "silver_passagem": ["valor_passagem", "taxa_servico"],
    "silver_pagamento": ["valor"],
    "silver_trecho": ["numero_diarias"],
}
# Key of each table of which the first row is kept.
KEEP_FIRST_KEYS = {
    "silver_viagem": ["id_viagem"],
    "silver_trecho": ["id_viagem", "sequencia_trecho"],
}
# Columns of silver_viagem computed from its other columns.
COMPUTED = ("valor_total", "duracao_dias")

GOLD_TABLE = "gold_resumo_executivo"
GOLD_VIEW = "view_gold_resumo_executivo"

# ---------------------------------------------------------------------------------------

# Technical column of the raw tables: position of the row in its source, 1..N. It orders
# "first row per key" and the generated ids; no question reads it.
ORDINAL = "_ordem"

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(12,2)": T.DecimalType(12, 2),
}


def _lines(text: str) -> list[list[str]]:
    return [line.split() for line in text.strip().splitlines()]


SILVER = {
    name: T.StructType([T.StructField(parts[0], _TYPES[parts[1]]) for parts in _lines(text)])
    for name, text in _SILVER.items()
}
SILVER_LENGTHS = {
    name: {parts[0]: int(parts[2]) for parts in _lines(text) if len(parts) == 3}
    for name, text in _SILVER.items()
}


def raw_columns(table: str) -> list[str]:
    """Columns of a raw table: its generated id, if any, then the mapped ones in file order."""
    generated = [GENERATED_IDS[table]] if table in GENERATED_IDS else []
    return generated + list(dict.fromkeys(HEADERS[table].values()))


RAW = {
    name: T.StructType([T.StructField(c, T.StringType()) for c in raw_columns(name)]
                       + [T.StructField(ORDINAL, T.LongType())])
    for name in HEADERS
}
