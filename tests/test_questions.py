from decimal import Decimal as D

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tripledger import answers, charts
from tripledger.plans import questions as q

TRIPS = "id_viagem string, cod_orgao_superior string, nome_orgao_superior string, " \
        "nome_viajante string, destinos string, duracao_dias int, valor_total decimal(12,2)"


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def frames(spark):
    rows = []

    def add(n, body, place, days, value, name="ana d'ávila "):
        for _ in range(n):
            rows.append((f"{len(rows):03}", "c" + body, body, name, place, days, D(value)))

    add(6, "A", "Natal/RN , Recife/PE", 3, "10.00")
    add(5, "B", "Recife/PE", 5, "900.00")
    add(6, "C", "Belém/PA", None, "0.03")
    add(1, "C", "Belém/PA,x", 9, "0.00")
    add(1, "D", "", 7, "-5.00")
    add(1, "E", None, 7, "1.00", None)
    add(1, "F", " Rio, x ", 7, "2.00", "JOÃO silva-sá")
    add(1, "G", "  ", 7, "2000.00")
    trips = spark.createDataFrame(rows, TRIPS)
    payments = spark.createDataFrame(
        [("000", "P1", "X", D("1.00")), ("000", "P1", "X", D("2.00")), ("001", "P2", " Y", D("9.00")),
         ("001", "P2", "Z", None), ("002", None, "", D("50.00")), ("002", "P1", None, D("1.00")),
         ("002", "P1", "  ", D("2.00"))],
        "id_viagem string, nome_orgao_pagador string, tipo_pagamento string, valor decimal(10,2)")
    segments = spark.createDataFrame(
        [("000", "Aéreo", "Natal", " sp"), ("000", "Aéreo", "Natal", "SP"),
         ("001", " Aéreo ", "Recife", "são "), ("006", "", "Recife", None), ("007", "  ", "Recife", " "),
         ("lost", None, "Lost", "")],
        "id_viagem string, meio_transporte string, destino_cidade string, destino_uf string")
    return trips.cache(), payments.cache(), segments.cache()


def test_bodies_by_cost(frames):
    trips, _, _ = frames
    top = [("B", D("4500.00")), ("G", D("2000.00")), ("A", D("60.00")), ("F", D("2.00")), ("E", D("1.00"))]
    assert tuples(q.q01(trips)) == top
    assert tuples(q.q07(trips)) == top[:3]
    assert q.q01(trips).columns == ["orgao", "custo_total"]


def test_destinations_need_more_than_five_trips(frames):
    trips, _, _ = frames
    assert tuples(q.q02(trips)) == [("Natal/RN", D("10.00")), ("Belém/PA", D("0.03"))]


def test_mean_cost_per_city(frames):
    trips, _, segments = frames
    assert tuples(q.q02_city(trips, segments)) == [("Recife", D("603.33")), ("Natal", D("10.00"))]


def test_longest_trip(frames):
    trips, _, _ = frames
    row = q.q03(trips).first()
    assert (row.duracao_dias, row.valor_total) == (7, D("1.00"))
    assert "TakeOrderedAndProject" in plan_of(q.q03(trips))


def test_payment_types(frames):
    _, payments, _ = frames
    assert tuples(q.q04(payments)) == [
        ("Z", 1, None, None), (" Y", 1, D("9.00"), D("9")), ("X", 2, D("3.00"), D("1.5"))]
    assert tuples(q.q07_payer(payments)) == [
        (None, D("50.00")), ("P2", D("9.00")), ("P1", D("6.00"))]
    assert tuples(q.q07_payer(payments, 1)) == [(None, D("50.00"))]


def test_transport(frames):
    _, _, segments = frames
    blank = "Não Informado"
    assert sorted(tuples(q.q05(segments))) == sorted(
        [("Aéreo", 2), ("Aéreo", 1), (blank, 1), (blank, 1), (blank, 1)])
    assert tuples(q.q05(segments))[0] == ("Aéreo", 2)
    merged = [("Aéreo", 3), (blank, 3)]
    assert tuples(q.q05(segments, merge_labels=True)) == merged
    assert tuples(q.q05_share(segments)) == [(*r, D("50.00")) for r in merged]


def test_states(frames):
    _, _, segments = frames
    assert tuples(q.q06(segments)) == [("SP", 2), ("SÃO", 1)]


def test_answers(frames):
    assert {r.pergunta: r.resposta for r in answers(*frames).collect()} == {
        "q01": "Maior custo total: B, R$ 4,500.00.",
        "q02": "Maior custo médio entre destinos com mais de 5 viagens: Natal/RN, R$ 10.00.",
        "q03": "Viagem mais longa: 7 dias, viajante Não Informado, destino Não Informado, custo R$ 1.00.",
        "q04": "Maior valor médio: Y, R$ 9.00 em 1 pagamentos, total R$ 9.00.",
        "q05": "Transporte mais usado: Aéreo, 2 trechos.",
        "q06": "UF de destino mais frequente: SP, 2 trechos.",
        "q07": "Maior valor consolidado: B, R$ 4,500.00.",
    }
    trips, payments, segments = frames
    trips = trips.where(F.col("nome_viajante").isNotNull())
    got = {r.pergunta: r.resposta
           for r in answers(trips, payments.where("valor IS NOT NULL"), segments).collect()}
    assert got["q03"] == "Viagem mais longa: 7 dias, viajante João Silva-Sá, destino Rio, x, custo R$ 2.00."
    assert got["q04"] == "Maior valor médio: Y, R$ 9.00 em 1 pagamentos, total R$ 9.00."
    empty = [df.where("id_viagem = 'none'") for df in frames]
    assert tuples(answers(*empty)) == []


def test_charts(frames):
    result = charts(*frames)
    assert tuples(result["q01"])[0] == (
        "B", D("4500.00"), "R$ 4,500.00", D("5760"), "R$ 0M")
    assert tuples(result["q02"])[0] == ("Natal/RN", D("10.00"), "R$ 10.00", D("12.5"), "R$ 0k")
    assert tuples(result["q03_dias"]) == [("Duração da Viagem", 7, "7 dias", D("8.75"))]
    assert tuples(result["q05"])[0] == ("Aéreo", 2, "2 trechos", D("2.5"))
    assert tuples(result["q06"]) == [("SP", 2, "2", D("2.4")), ("SÃO", 1, "1", D("2.4"))]
    negative = frames[0].where("nome_orgao_superior = 'D'")
    assert tuples(charts(negative, *frames[1:])["q07"])[0][:3] == ("D", D("-5.00"), None)
