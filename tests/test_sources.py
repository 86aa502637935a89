import gzip
import random
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.operators import number_chunks
from tripledger.schemas import ORDINAL
from tripledger.sources import (
    create_tables,
    find_file,
    has_open_quotes,
    read_delimited,
    publish,
    replace_table,
    rows_to_table,
    write_version,
)
from tripledger.sources import delimited
from tripledger.sources.delimited import ORIGIN
from tripledger.sources.records import with_states
from tripledger.staging import Staging

EDGE = (
    ' Nome ;SITUAÇÃO;C\n'
    '"x;y"; sp ;ção\n'
    '"l1\nl2";b;c\n'
    '"q""q";NA;""\n'
    '\n'
    '   \n'
    'short;1\n'
    'long;1;2;3\n'
    'long;1;2;\n'
    '"lo;ng";1;"2;2";3\n'
    'st"ray;NULL;nan\n'
    '5" a;7" b;c\n'
    ';;\n'
)
NAMES = {"nome": "n", "situação": "s", "c": "c"}
ROWS = [
    ("x;y", " sp ", "ção"), ("l1\nl2", "b", "c"), ('q"q', None, None), ("short", "1", None),
    ('st"ray', None, None), ('5" a', '7" b', "c"), (None, None, None),
]


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("latin-1"))
    return str(path)


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_edge_rows(spark, tmp_path):
    path = put(tmp_path / "a.csv", EDGE)
    df = read_delimited(spark, path, NAMES)
    assert df.columns == ["n", "s", "c"]
    assert tuples(df) == ROWS
    assert df.count() == len(ROWS) == df.select("n").count()


def test_edge_rows_agree_with_pandas(spark, tmp_path):
    pd = pytest.importorskip("pandas")
    path = put(tmp_path / "a.csv", EDGE)
    frame = pd.read_csv(path, sep=";", encoding="latin-1", dtype=str, on_bad_lines="skip")
    expected = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    assert tuples(read_delimited(spark, path)) == expected == ROWS


FIELD = st.one_of(
    st.sampled_from(["", "a", " b ", "ção", "NA", "1,5", 'x"y', '5" z', "a b"]),
    st.text('ab ;"\n', max_size=6).map(lambda v: '"' + v.replace('"', '""') + '"'))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(FIELD, min_size=1, max_size=4), min_size=1, max_size=12))
def test_random_rows_agree_with_pandas(spark, tmp_path, records):
    pd = pytest.importorskip("pandas")
    # pandas does not check the length of the first row against the header.
    lines = ["A;B;C", "1;2;3", *(";".join(r) for r in records)]
    path = put(tmp_path / f"{uuid.uuid4().hex}.csv", "\n".join(lines) + "\n")
    frame = pd.read_csv(path, sep=";", encoding="latin-1", dtype=str, on_bad_lines="skip")
    expected = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    assert tuples(read_delimited(spark, path)) == expected


def test_rows_without_line_breaks_are_read_in_splits(spark, tmp_path):
    text = EDGE.replace("l1\nl2", "l1 l2")
    path = put(tmp_path / "a.csv", text)
    assert has_open_quotes(spark, put(tmp_path / "b.csv", EDGE), ";")
    assert not has_open_quotes(spark, path, ";")
    split = tuples(read_delimited(spark, path, NAMES, multi_line=False))
    assert split == tuples(read_delimited(spark, path, NAMES, multi_line=True))
    assert split == [("l1 l2", *r[1:]) if r[0] == "l1\nl2" else r for r in ROWS]


def test_literals_can_be_kept(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a;b\nNA;NULL\n")
    assert tuples(read_delimited(spark, path)) == [(None, None)]
    assert tuples(read_delimited(spark, path, keep_literals=True)) == [("NA", "NULL")]


def test_columns(spark, tmp_path):
    path = put(tmp_path / "a.csv", "B;unknown; ID_x ;A\n1;2;3;4\n")
    names = {"a": "alpha", "b": "beta", "z": "zeta"}
    assert read_delimited(spark, path, names).columns == ["beta", "id_x", "alpha"]
    wide = read_delimited(spark, path, names, ["alpha", "beta", "zeta", "id_x"])
    assert tuples(wide) == [("4", "1", None, "3")]
    with pytest.raises(ValueError, match="id_x"):
        read_delimited(spark, path, names, ["alpha", "beta", "zeta"])
    both = put(tmp_path / "b.csv", "nome;nome do viajante\n1;2\n")
    with pytest.raises(ValueError, match="same column"):
        read_delimited(spark, both, {"nome": "n", "nome do viajante": "n"})


def test_repeated_and_empty_headers_are_read_by_position(spark, tmp_path):
    path = put(tmp_path / "a.csv", "A;x;x;;a b.c\n1;2;3;4;5\n")
    df = read_delimited(spark, path, {"a": "alpha", "a b.c": "dotted"})
    assert tuples(df) == [("1", "5")]


def test_many_files_need_the_same_header(spark, tmp_path):
    put(tmp_path / "d" / "1.csv", "A;B\n1;2\n")
    put(tmp_path / "d" / "2.csv", "A;B\n3;4\n")
    folder = str(tmp_path / "d")
    assert sorted(tuples(read_delimited(spark, folder))) == [("1", "2"), ("3", "4")]
    put(tmp_path / "d" / "3.csv", "B;A\n5;6\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_delimited(spark, folder).collect()


def test_find_file(spark, tmp_path):
    put(tmp_path / "z" / "a.csv", "1")
    put(tmp_path / "b c" / "a.csv", "2")
    put(tmp_path / "b c" / "other.csv", "2")
    assert find_file(spark, str(tmp_path), "a.csv").endswith("/b c/a.csv")
    put(tmp_path / "a.csv", "3")
    assert find_file(spark, str(tmp_path), "a.csv").endswith(f"{tmp_path}/a.csv")
    assert find_file(spark, str(tmp_path), "none.csv") is None
    assert find_file(spark, str(tmp_path / "absent"), "a.csv") is None


def test_tables(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    create_tables(spark, {"t": schema}, "src")
    assert spark.table("src.t").schema == schema and spark.table("src.t").count() == 0
    assert rows_to_table(spark, [], schema, "t", "src") == 0
    assert rows_to_table(spark, [(1, "x"), (2, "y")], schema, "t", "src") == 2
    assert rows_to_table(spark, [(3, None)], schema, "t", "src") == 1
    assert sorted(tuples(spark.table("src.t"))) == [(1, "x"), (2, "y"), (3, None)]
    for _ in range(2):
        replace_table(spark.createDataFrame([(7, "n")], schema), "u", "src")
    for value in (7, 8):
        publish(spark, {"t": write_version(spark.createDataFrame([(value, "n")], schema), "t", "src")}, "src")
        assert tuples(spark.table("src.t")) == [(value, "n")]
    assert rows_to_table(spark, [(9, "o")], schema, "t", "src") == 1
    assert sorted(tuples(spark.table("src.t"))) == [(8, "n"), (9, "o")]
    assert len([t for t in spark.catalog.listTables("src") if t.name.startswith("t__v")]) == 2
    create_tables(spark, {"t": schema}, "src")
    assert spark.table("src.t").count() == 0
    assert ORDINAL not in spark.table("src.t").columns


@pytest.fixture
def staging(spark):
    with Staging(spark) as staging:
        yield staging


def test_an_unclosed_quote_stops_the_read(spark, tmp_path):
    lines = [f"{k};x;y" for k in range(10_000)]
    lines[9] = '9;"x;y'
    put(tmp_path / "a.csv", "A;B;C\n" + "\n".join(lines) + "\n")
    with pytest.raises(Exception, match="ASPAS_ABERTAS.*a.csv.*9;"):
        read_delimited(spark, str(tmp_path / "a.csv")).collect()
    rows = read_delimited(spark, str(tmp_path / "a.csv"), open_quotes="lines")
    assert rows.count() == 10_000 and rows.where("A <> '9' AND B = 'x' AND C = 'y'").count() == 9_999
    with pytest.raises(ValueError):
        read_delimited(spark, str(tmp_path / "a.csv"), open_quotes="guess")


def test_an_empty_file_and_headers_in_another_order_are_errors(spark, tmp_path):
    put(tmp_path / "empty.csv", "")
    with pytest.raises(ValueError, match="empty.csv is empty"):
        read_delimited(spark, str(tmp_path / "empty.csv"))
    put(tmp_path / "d" / "1.csv", "A;B;;\n1;2;3;4\n")
    put(tmp_path / "d" / "2.csv", "A;B;;\r\n5;6;7;8\r\n")
    names = {"a": "a", "b": "b"}
    assert sorted(tuples(read_delimited(spark, str(tmp_path / "d"), names))) == [("1", "2"), ("5", "6")]
    put(tmp_path / "d" / "3.csv", "B;A;;\n1;2;3;4\n")
    with pytest.raises(ValueError, match="different headers.*1.csv.*3.csv"):
        read_delimited(spark, str(tmp_path / "d"), names)


def test_skipped_records_are_counted(spark, tmp_path):
    put(tmp_path / "a.csv", "A;B\n1;2\n1;2;3\n\n   \n4\n1;2;3;4\n")
    skipped = Observation("skipped")
    rows = read_delimited(spark, str(tmp_path / "a.csv"), skipped=skipped)
    assert len(rows.collect()) == 2 and skipped.get == {"longa": 2}


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for name in ("files.maxPartitionBytes", "files.openCostInBytes", "adaptive.coalescePartitions.enabled"):
        spark.conf.unset(f"spark.sql.{name}")


def numbered(spark, path, staging, **options):
    rows = read_delimited(spark, path, with_origin=True, staging=staging, **options)
    *chunk, row = ORIGIN
    return rows, tuples(number_chunks(staging.put(rows, "rows"), "n", chunk, row, staging).orderBy("n"))


def test_files_with_and_without_line_breaks_in_fields(spark, tmp_path, staging, small_splits):
    for k in range(4):
        body = "".join(f"{k}{i:04};{'x' * 40}\n" for i in range(2000))
        put(tmp_path / f"{k}.csv", "A;B\n" + (f'{k}first;"line\nbreak"\n' if k == 2 else "") + body)
    rows, got = numbered(spark, str(tmp_path), staging)
    assert rows.rdd.getNumPartitions() > 20
    want = [f"{k}{i:04}" for k in range(4) for i in range(2000)]
    want.insert(4000, "2first")
    assert [r[1] for r in got] == want and got[4000][2] == "line\nbreak"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_with_line_breaks_is_read_in_many_tasks(spark, tmp_path, staging, small_splits, end):
    """Fields with line breaks, quotes and separators, some longer than a split, all over the file."""
    lines = ["", "A;B;C"]
    for k in range(3000):
        text = ("x" * 150, f"a{end}b", '""q"";' + end, end * 3, "y" * 25_000 + end + '""' if k % 997 == 0 else "z" * 60)[k % 5]
        lines.append(f'{k:05};"{text}";{"" if k % 3 else chr(34) + "t" + chr(34)}')
        if k % 50 == 0:
            lines += ["", "  ", f"{k};1;2;3", f"{k:05}b"]
    path = put(tmp_path / "a.csv", end.join(lines) + end)
    rows, got = numbered(spark, path, staging)
    assert rows.rdd.getNumPartitions() >= 8
    scans = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
    assert scans > 8
    as_one = [r[:3] for r in tuples(read_delimited(spark, path, multi_line=True)) if (r[0] or "").strip()]
    assert len(got) == 3000 + 60  # Spark makes line feeds of other line ends when it reads a whole file
    assert [tuple(x and x.replace("\r\n", "\n") for x in r[1:]) for r in got] == as_one
    assert [r[0] for r in got] == list(range(1, len(got) + 1))
    assert sum(end in (r[2] or "") for r in got) > 1000


def test_carriage_returns_alone_are_left_to_the_reader(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'A;B\r1;"x\ry"\r2;z\r')
    assert tuples(read_delimited(spark, path)) == tuples(read_delimited(spark, path, multi_line=True))


def test_headers_are_read_without_the_rest_of_the_file(spark, tmp_path):
    """The tail of the second file cannot be unpacked, which its first line does not need."""
    draw = random.Random(1)
    for name, cut in (("1", 0), ("2", 400_000)):
        body = "A;B;;\n" + "".join(f"{draw.random()};{draw.random()};x;y\n" for _ in range(60_000))
        packed = gzip.compress(body.encode())
        (tmp_path / f"{name}.csv.gz").write_bytes(packed[:len(packed) - cut] if cut else packed)
    files = [str(tmp_path / f"{k}.csv.gz") for k in "12"]
    assert delimited.first_lines(spark, files) == ["A;B;;"] * 2
    delimited._check_same_headers(spark, files)
    with pytest.raises(Exception, match="EOF|Unexpected end"):
        spark.read.text(files[1]).count()


def test_states_against_a_plain_walk(spark):
    rng = random.Random(3)
    rows = [(g, k, rng.random() < 0.5, rng.random() < 0.5) for g in range(6) for k in range(rng.randrange(1, 30))]
    df = spark.createDataFrame(rows, "g int, k int, shut boolean, still boolean")
    got = {(r.g, r.k): (r.s0, r.s1) for r in with_states(df, ["g"], "k", "shut", "still").collect()}
    for g in range(6):
        for begin in (False, True):
            state = begin
            for _, k, shut, still in sorted(r for r in rows if r[0] == g):
                assert got[g, k][begin] == state
                state = still if state else shut


def test_lines_of_plain_quoted_fields_need_no_pattern(spark):
    from tripledger.sources.records import all_quoted, left_open
    plain = ['"a";"b"', '"";"";""', '""', '"a;b";"c"', '"é";"ç"']
    other = ['', '"', '"a', '"a";b', 'a;"b"', '"a";"b', '"a""b";"c"', '"a"x";"b"', 'x"y;"abc"', '"a";"', ';";";"', '"a";"b" ']
    df = spark.createDataFrame([(x,) for x in plain + other], "x string")
    rows = df.select("x", all_quoted(F.col("x"), ";").alias("q"), left_open(F.col("x"), ";").alias("o")).collect()
    assert [r.x for r in rows if r.q] == plain
    assert not any(r.q and r.o for r in rows)


def test_a_quoted_separator_is_a_plain_field(spark):
    from tripledger.sources.records import all_quoted, left_open
    cases = {'";"': True, '"a";";";"b"': True, '"a"\n': False, '"a;"b': False}
    df = spark.createDataFrame([(x,) for x in cases], "x string")
    rows = df.select("x", all_quoted(F.col("x"), ";").alias("q"), left_open(F.col("x"), ";").alias("o")).collect()
    assert {r.x: r.q for r in rows} == cases
    assert not any(r.q and r.o for r in rows)
