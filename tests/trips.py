"""Small trip files in the published format, with the edge cases the loads must handle."""

from tripledger.schemas import FILES, HEADERS



def _line(values):
    return ";".join('"' + v.replace('"', '""') + '"' for v in values)


def csv(table, rows, skip=("nome do viajante",), extra=()):
    headers = [h for h in HEADERS[table] if h not in skip]
    lines = [_line([*(f" {h.upper()} " for h in headers), "Coluna Extra"])]
    lines += [_line([*(r.get(HEADERS[table][h], "") for h in headers), "x"]) for r in rows]
    return "\n".join([*lines, *extra]) + "\n"


def trip(key, **values):
    return {"id_viagem": key, "num_proposta": "p" + key, "situacao": "Realizada",
            "viagem_urgente": "NÃO", "cod_orgao_superior": "10", "nome_orgao_superior": "Ministério A",
            "cpf_viajante": "***", "nome_viajante": "ANA D'ÁVILA", "funcao": "f", "cargo": "c",
            "data_inicio": "01/02/2025", "data_fim": "3/2/2025", "destinos": "Recife/PE, Natal/RN",
            "motivo": "reunião; de\nlinha", "valor_diarias": "1.000,50", "valor_passagens": "200,00",
            "valor_devolucao": "0,50", "valor_outros_gastos": "", **values}


def payment(key, **values):
    return {"id_viagem": key, "num_proposta": "p", "nome_orgao_pagador": "Órgão P",
            "nome_ug_pagadora": "UG", "tipo_pagamento": "DIÁRIAS", "valor": "10,00", **values}


def ticket(key, **values):
    return {"id_viagem": key, "meio_transporte": "Aéreo", "pais_origem_ida": "Brasil",
            "uf_origem_ida": "DF", "cidade_origem_ida": "Brasília", "pais_destino_ida": "Brasil",
            "uf_destino_ida": "PE", "cidade_destino_ida": "Recife", "valor_passagem": "500,00",
            "taxa_servico": "0,00", "data_emissao": "1/1/2025", "dados_volta_passagem": "v", **values}


def segment(key, n, **values):
    return {"id_viagem": key, "sequencia_trecho": str(n), "origem_data": "01/02/2025",
            "origem_uf": "DF", "origem_cidade": "Brasília", "destino_data": "02/02/2025",
            "destino_uf": " pe", "destino_cidade": "Recife", "meio_transporte": "Aéreo",
            "numero_diarias": "1,5", **values}


GOOD = {
    "raw_viagem": [
        trip("1"),
        trip("2", valor_diarias="", valor_passagens="", valor_devolucao="5,00", data_fim=""),
        trip("1", nome_orgao_superior="repetida"),
        trip("3", cod_orgao_superior="20", nome_orgao_superior="Ministério B", destinos="Natal/RN",
             data_inicio="10/02/2025", data_fim="01/02/2025", valor_diarias="3.000,00",
             nome_viajante="NA"),
    ],
    "raw_pagamento": [payment("1"), payment("9", valor="ruim"), payment("1", valor="1.234,56"),
                      payment("3", tipo_pagamento="PASSAGEM", valor=""), payment("")],
    "raw_passagem": [ticket("2"), ticket("8"), ticket("3", valor_passagem="")],
    "raw_trecho": [
        segment("1", 1), segment("1", 2, destino_uf="rn "), segment("1", 1, destino_cidade="repetido"),
        segment("1", ""), segment("1", ""), segment("7", 1, sequencia_trecho="ruim"),
        segment("3", 1, meio_transporte="  "), segment("2", 1, meio_transporte="")],
}

BAD = {
    "raw_viagem": GOOD["raw_viagem"] + [
        trip(""), trip("4", nome_orgao_superior=""), trip("5", valor_diarias="-1,00"),
        trip("1", data_inicio="31/02/2025"), trip("6", viagem_urgente="talvez")],
    "raw_pagamento": GOOD["raw_pagamento"] + [payment("1", tipo_pagamento="", valor="-2,00"),
                                              payment("4")],
    "raw_passagem": GOOD["raw_passagem"],
    "raw_trecho": GOOD["raw_trecho"] + [segment("1", 1, numero_diarias="-1"), segment("1", "1.5")],
}


def write_files(folder, data, without=()):
    folder.mkdir(parents=True, exist_ok=True)
    for table, rows in data.items():
        if table not in without:
            (folder / FILES[table]).write_bytes(csv(table, rows).encode("latin-1"))
    return str(folder)
