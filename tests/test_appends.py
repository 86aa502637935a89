"""Raw tables that are filled by several calls."""

import os

import pytest
from trips import GOOD, payment, segment, ticket, write_files

from tripledger import append_raw, build_silver, load_raw
from tripledger.operators import RuleViolation
from tripledger.plans import raw as raw_plan
from tripledger.plans.raw import FileChanged, compact_raw, file_ledger
from tripledger.schemas import FILES, ORDINAL, RAW
from tripledger.sources import PublishConflict, create_tables, current_parts, current_versions, publish, write_version

PAYMENTS, SEGMENTS = {"raw_pagamento": "p.csv"}, {"raw_trecho": "t.csv"}
ROWS = [payment(str(i), valor=f"{i},00", nome_ug_pagadora="a\nb" if i % 4 == 0 else "UG") for i in range(30)]


def batch(folder, number, rows, table="raw_pagamento"):
    write_files(folder / f"lote-{number}", {table: rows})
    return f"{folder}/lote-{number}/{FILES[table]}"


def rows_of(spark, database, table="raw_pagamento"):
    return [tuple(r) for r in spark.table(f"{database}.{table}").orderBy(ORDINAL).collect()]


def append(spark, database, paths, files=PAYMENTS, **options):
    table = next(iter(files))
    report = append_raw(spark, "", database, files, {table: paths}, **options).first()
    return report.linhas, report.situacao


@pytest.mark.parametrize("max_parts", [1, 2, 64])
def test_appends_give_the_rows_and_numbers_of_one_load(spark, tmp_path, max_parts):
    paths = [batch(tmp_path, n, ROWS[a:b]) for n, (a, b) in enumerate([(0, 9), (9, 9), (9, 20), (20, 30)])]
    one, many = f"ap1_{max_parts}", f"ap2_{max_parts}"
    load_raw(spark, "", one, PAYMENTS, {"raw_pagamento": paths})
    assert append(spark, many, paths[:1], max_parts=max_parts) == (9, "carregada")
    assert append(spark, many, paths[:3], max_parts=max_parts) == (11, "carregada")
    assert append(spark, many, paths[:3], max_parts=max_parts) == (0, "em dia")
    assert append(spark, many, paths, max_parts=max_parts) == (10, "carregada")
    assert rows_of(spark, one) == rows_of(spark, many) and len(rows_of(spark, one)) == 30
    assert spark.table(f"{many}.raw_pagamento").schema == RAW["raw_pagamento"]
    assert len(current_parts(spark, "raw_pagamento", many)) == {1: 1, 2: 1, 64: 3}[max_parts]
    held = [[(r.primeira, r.linhas) for r in file_ledger(spark, "raw_pagamento", d).orderBy("arquivo").collect()]
            for d in (one, many)]
    assert held[0] == held[1] == [(1, 9), (10, 0), (10, 11), (21, 10)]


def test_a_load_is_followed_by_appends_and_replaces_them(spark, tmp_path):
    first, second = batch(tmp_path, 1, ROWS[:5]), batch(tmp_path, 2, ROWS[5:9])
    load_raw(spark, "", "ap3", PAYMENTS, {"raw_pagamento": first})
    assert append(spark, "ap3", [first, second]) == (4, "carregada")
    assert [r[-1] for r in rows_of(spark, "ap3")] == list(range(1, 10))
    load_raw(spark, "", "ap3", PAYMENTS, {"raw_pagamento": second})
    assert len(rows_of(spark, "ap3")) == 4
    assert append(spark, "ap3", [first, second]) == (5, "carregada")
    assert [r[-1] for r in rows_of(spark, "ap3")] == list(range(1, 10))


def test_tables_without_a_list_of_files(spark, tmp_path):
    """A table made by ``create_tables``, with rows from elsewhere, keeps them."""
    spark.sql("CREATE DATABASE IF NOT EXISTS ap4")
    create_tables(spark, {"raw_pagamento": RAW["raw_pagamento"]}, "ap4")
    path = batch(tmp_path, 1, ROWS[:3])
    assert append(spark, "ap4", path) == (3, "carregada")
    assert [r[-1] for r in rows_of(spark, "ap4")] == [1, 2, 3]
    publish(spark, {"raw_pagamento": write_version(spark.table("ap4.raw_pagamento"), "raw_pagamento", "ap4")}, "ap4")
    assert append(spark, "ap4", batch(tmp_path, 2, ROWS[3:5])) == (2, "carregada")
    assert [r[-1] for r in rows_of(spark, "ap4")] == [1, 2, 3, 4, 5]


def test_a_changed_file_is_an_error(spark, tmp_path):
    path = batch(tmp_path, 1, ROWS[:3])
    append(spark, "ap5", path)
    with open(path, "ab") as file:
        file.write(b'"x"\n')
    with pytest.raises(FileChanged, match="raw_pagamento: .*lote-1"):
        append(spark, "ap5", path)
    batch(tmp_path, 1, ROWS[:3])
    os.utime(path, (1, 1))
    with pytest.raises(FileChanged):
        append(spark, "ap5", path)
    assert len(rows_of(spark, "ap5")) == 3


def test_a_missing_file_leaves_the_table_as_it_is(spark, tmp_path):
    write_files(tmp_path / "a" / "b", {"raw_passagem": [ticket("1")]})
    only = {"raw_passagem": FILES["raw_passagem"]}
    for folder, expected in (("a", (1, "carregada")), ("a", (0, "em dia")), ("none", (0, "ausente"))):
        report = append_raw(spark, f"{tmp_path}/{folder}", "ap6", only).first()
        assert (report.linhas, report.situacao) == expected
    assert len(rows_of(spark, "ap6", "raw_passagem")) == 1


def test_an_append_that_stops_leaves_everything(spark, tmp_path):
    first = batch(tmp_path, 1, [segment("1", 1)], "raw_trecho")
    long = batch(tmp_path, 2, [segment("1", 2, destino_cidade="x" * 256), segment("1", 3)], "raw_trecho")
    append(spark, "ap7", first, SEGMENTS)
    before = sorted(t.name for t in spark.catalog.listTables("ap7"))
    with pytest.raises(RuleViolation, match="tamanho:destino_cidade"):
        append(spark, "ap7", [first, long], SEGMENTS)
    assert sorted(t.name for t in spark.catalog.listTables("ap7")) == before
    assert append(spark, "ap7", [first, long], SEGMENTS, mode="quarantine") == (1, "carregada")
    assert [r[-1] for r in rows_of(spark, "ap7", "raw_trecho")] == [1, 3]
    again = batch(tmp_path, 3, [segment("2", 1, origem_cidade="y" * 256)], "raw_trecho")
    assert append(spark, "ap7", again, SEGMENTS, mode="quarantine") == (0, "carregada")
    assert sorted(r[ORDINAL] for r in spark.table("ap7.quarentena_raw_trecho").collect()) == [2, 4]
    compact_raw(spark, "raw_trecho", "ap7")
    assert len(current_parts(spark, "quarentena_raw_trecho", "ap7")) == 1
    assert sorted(r[ORDINAL] for r in spark.table("ap7.quarentena_raw_trecho").collect()) == [2, 4]
    assert append(spark, "ap7", [first, long, again], SEGMENTS) == (0, "em dia")


@pytest.mark.parametrize("step", ["append", "load", "compact"])
def test_a_writer_that_dies_between_its_names(spark, tmp_path, monkeypatch, step):
    """The list of files has changed and the table has not: nothing is lost or loaded twice."""
    database = f"ap8_{step}"
    paths = [batch(tmp_path, n, ROWS[4 * n:4 * n + 4]) for n in range(3)]
    for path in paths[:2]:
        append(spark, database, path)

    def dies(spark, versions, database, base, after=None):
        first = next(iter(versions))
        assert first == "arquivos_raw_pagamento"
        publish(spark, {first: versions[first]}, database, base, after=after)
        raise KeyboardInterrupt
    with monkeypatch.context() as patch:
        patch.setattr(raw_plan, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            if step == "append":
                append(spark, database, paths)
            elif step == "load":
                load_raw(spark, "", database, PAYMENTS, {"raw_pagamento": paths[1:]})
            else:
                compact_raw(spark, "raw_pagamento", database)
    assert [r[-1] for r in rows_of(spark, database)] == list(range(1, 9))
    assert append(spark, database, paths) == (4, "carregada")
    assert [r[-1] for r in rows_of(spark, database)] == list(range(1, 13))


def test_an_append_and_a_load_at_once(spark, tmp_path):
    first, second = batch(tmp_path, 1, ROWS[:2]), batch(tmp_path, 2, ROWS[2:4])
    append(spark, "ap9", first)
    base = current_versions(spark, ["raw_pagamento"], "ap9")
    version = write_version(spark.table("ap9.raw_pagamento"), "raw_pagamento", "ap9")
    append(spark, "ap9", second)
    with pytest.raises(PublishConflict):
        publish(spark, {"raw_pagamento": version}, "ap9", base)
    publish(spark, {"raw_trecho": write_version(spark.createDataFrame([], RAW["raw_trecho"]), "raw_trecho", "ap9")},
            "ap9", keep_hours=0)
    assert len(rows_of(spark, "ap9")) == 4


def test_parts_stay_when_old_versions_go(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS ap10")
    shown = []
    for n in range(4):
        version = write_version(spark.range(n, n + 1), "t", "ap10")
        publish(spark, {"t": version}, "ap10", keep_hours=0, after={"t": shown})
        shown = current_parts(spark, "t", "ap10")
    assert sorted(r.id for r in spark.table("ap10.t").collect()) == [0, 1, 2, 3] and len(shown) == 4


def test_silver_from_appended_tables(spark, tmp_path):
    """Rows after two appends of all tables are those of one load of the same rows."""
    half = {t: rows[:len(rows) // 2] for t, rows in GOOD.items()}
    rest = {t: rows[len(rows) // 2:] for t, rows in GOOD.items()}
    load_raw(spark, write_files(tmp_path / "one", GOOD), "ap11")
    for n, data in enumerate((half, rest)):
        append_raw(spark, write_files(tmp_path / str(n), data), "ap12")
    for database in ("ap11", "ap12"):
        build_silver(spark, database, mode="quarantine")
    for table in ("silver_viagem", "silver_pagamento", "silver_passagem", "silver_trecho"):
        one, two = (sorted(map(str, spark.table(f"{d}.{table}").collect())) for d in ("ap11", "ap12"))
        assert one == two
