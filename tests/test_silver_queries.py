"""The queries of the silver layer: what they store on the way to their results."""

import datetime

import pytest

from tripledger.staging import Staging
from tripledger.workload import catalog
from tripledger.workload.roles import LINE_ORDER

DAY = datetime.datetime(2025, 1, 2)


@pytest.fixture
def folder(spark, tmp_path):
    """Orders 1 to 4, of which 1 and 2 are closed; line 1 of order 1 stands there three times."""
    lines = [(o, p, 1, n, 3.0, 1234.5, 0.0, 0.02, "N", "O", DAY)
             for o, p, n in ((1, 10, 1), (1, 11, 1), (1, 12, 1), (1, 10, 2), (2, 10, 1), (3, 10, 1), (4, 10, 7), (None, 10, 1))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "F"), (2, "F"), (3, "O"), (4, "O")], "o_orderkey long, o_orderstatus string").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(p, "p") for p in (10, 11, 12)], "p_partkey long, p_name string").write.parquet(
        str(tmp_path / "part.parquet"))
    return str(tmp_path)


@pytest.fixture
def staged(monkeypatch):
    """The columns of every table that is staged."""
    found, put = [], Staging.put
    monkeypatch.setattr(Staging, "put", lambda self, df, label: (found.append(df.columns), put(self, df, label))[1])
    return found


def test_relations_store_no_text(spark, folder, staged):
    rows = catalog.queries()["silver_relations"](spark, folder).collect()
    assert {(r.tabela, r.regra): r.violacoes for r in rows} == {
        ("silver_viagem", "unico:id_viagem"): 3, ("silver_pagamento", "existe:id_viagem"): 3,
        ("silver_passagem", "existe:id_viagem"): 3, ("silver_trecho", "existe:id_viagem"): 3,
        ("silver_trecho", "unico:id_viagem+sequencia_trecho"): 2}
    assert not staged


@pytest.mark.parametrize("query, count", [("silver_trip", 3), ("silver_trip_quarantine", 2), ("silver_segment", 3)])
def test_line_items_are_numbered_before_text_is_made(spark, folder, staged, query, count):
    rows = catalog.queries()[query](spark, folder).collect()
    assert len(rows) == count
    assert staged and not any("id_viagem" in columns for columns in staged)
    assert all(set(columns) <= {"l_orderkey", *LINE_ORDER, "_chunk", "_row", "_first", "_offset"} for columns in staged)
