import json
import sqlite3

import pytest
from conftest import values
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tidefeed.sources import (
    any_of,
    id_number_pairs,
    load,
    load_split,
    read_database,
    read_delimited,
    read_jdbc_table,
)

PAIR = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    return write


def test_arity(spark, put):
    path = put("arity.csv", "a,b\n1\n2,x\n3,y,z\n\n4,w\n")
    parts = load_split(spark, path)
    assert values(parts.accepted) == [(2, "x"), (4, "w")]
    assert values(parts.rejected) == [("arity", "1"), ("arity", "3,y,z")]


def test_acceptance_does_not_depend_on_the_selected_columns(spark, put):
    path = put("lines.csv", "a,b,c\nx,y,1\nshort,2\nx,y,z,4\nq,r,bad\n")
    schema = T.StructType(
        [
            T.StructField("a", T.StringType()),
            T.StructField("b", T.StringType()),
            T.StructField("c", T.IntegerType()),
        ]
    )
    parts = load_split(spark, path, schema)
    assert parts.accepted.count() == 1
    assert parts.accepted.select("a").collect() == [("x",)]
    assert parts.accepted.groupBy().count().first()[0] == 1
    assert parts.rejected.count() == 3
    text_only = read_delimited(spark, put("text.csv", "a,b\nx,y\nz\n"))
    assert text_only.accepted.count() == 1
    assert text_only.rejected.count() == 1


def test_quotes(spark, put):
    path = put("quotes.csv", 'a,b\n1,"x,y"\n2,"he said ""hi"""\n3,back\\slash\n')
    assert values(load(spark, path)) == [(1, "x,y"), (2, 'he said "hi"'), (3, "back\\slash")]


def test_tab_separated(spark, put):
    assert values(load(spark, put("t.txt", "a\tb\n1\tx,y\n"))) == [(1, "x,y")]


def test_all_rows_are_kept(spark, put):
    path = put("nine.csv", "a\n" + "".join(f"{i}\n" for i in range(1, 31)))
    assert load(spark, path).count() == 30


def test_inferred_types(spark, put):
    path = put("types.csv", "i,d,s,date,flag,e\n1,1.5,x,2024-01-01,true,\n2,3,7,2024-01-02,false,\n")
    kinds = [f.dataType.simpleString() for f in load(spark, path).schema]
    assert kinds == ["int", "double", "string", "string", "string", "string"]
    assert load(spark, path).first()["date"] == "2024-01-01"


def test_a_late_bad_value_widens_an_inferred_column(spark, put):
    lines = "".join(f"{i},a\n" for i in range(1, 20))
    frame = load(spark, put("late.csv", "i,s\n" + lines + "3.7,b\n"))
    assert frame.schema["i"].dataType == T.DoubleType()
    assert frame.count() == 20


def test_a_late_bad_value_is_set_aside_under_a_schema(spark, put):
    lines = "".join(f"{i},a\n" for i in range(1, 20))
    parts = load_split(spark, put("late.csv", "id,v\n" + lines + "x,b\n3.7,c\n12abc,d\n"), PAIR)
    assert parts.accepted.count() == 19
    assert [r.motivo for r in parts.rejected.collect()] == ["type:id"] * 3


def test_a_schema_is_matched_by_name_or_else_by_position(spark, put):
    by_name = load(spark, put("named.csv", "v,extra,id\na,q,1\nb,r,2\n"), PAIR)
    assert values(by_name) == [(1, "a"), (2, "b")] and by_name.columns == ["id", "v"]
    assert values(load(spark, put("other.csv", "x,y\n1,a\n"), PAIR)) == [(1, "a")]


def test_missing_numbers_drop_the_row_and_missing_text_does_not(spark, put):
    parts = load_split(spark, put("missing.csv", "id,v\n,x\n1,\n2,y\n"), PAIR)
    assert values(parts.accepted) == [(1, None), (2, "y")]
    assert [r.motivo for r in parts.rejected.collect()] == ["missing:id"]


def test_empty_inputs(spark, put):
    with pytest.raises(ValueError, match="no header"):
        load(spark, put("empty.csv", ""))
    header_only = put("header.csv", "a,b\n")
    assert load(spark, header_only).count() == 0
    with pytest.raises(ValueError, match="no valid row"):
        load(spark, header_only, require_rows=True)


def test_unknown_suffix_and_missing_file(spark, put, tmp_path):
    for name in ("a.foo", "a.CSV", "plain"):
        with pytest.raises(ValueError, match="unsupported"):
            load(spark, put(name, "a\n1\n"))
    with pytest.raises(AnalysisException):
        load(spark, str(tmp_path / "absent.csv"))


def test_accepted_and_rejected_make_the_input(spark, put):
    path = put("mix.csv", "id,v\n1,a\n2\nx,b\n,c\n5,d,e\n6,f\n")
    parts = load_split(spark, path, PAIR)
    assert parts.accepted.count() + parts.rejected.count() == 6
    stored = parts.stored()
    assert values(stored.accepted) == values(parts.accepted)
    assert values(stored.rejected) == values(parts.rejected)


def test_json_array(spark, put):
    objects = [
        {"b": 1, "a": "x", "c": 1.5, "d": True, "e": {"k": [1, 2]}},
        {"a": None, "c": 2, "b": 3, "z": 9},
        {"b": 4, "c": 1.0, "a": "m"},
    ]
    frame = load(spark, put("ragged.json", json.dumps(objects)))
    assert frame.columns == ["a", "b", "c", "d", "e"]
    assert values(frame.drop("e")) == [
        (None, 3, 2.0, None),
        ("m", 4, 1.0, None),
        ("x", 1, 1.5, "true"),
    ]
    assert json.loads(frame.where("a = 'x'").first()["e"]) == {"k": [1, 2]}


def test_json_key_that_starts_as_null_is_text(spark, put):
    frame = load(spark, put("n.json", json.dumps([{"a": 1, "b": None}, {"a": 2, "b": 3}])))
    assert values(frame) == [(1, None), (2, "3")]


def test_files_that_are_no_array_are_set_aside(spark, put, tmp_path):
    object_file = put("object.json", '{"id": 1}')
    assert values(load_split(spark, object_file).rejected) == [("json", '{"id": 1}')]
    assert load(spark, put("none.json", "[]")).count() == 0
    put("good.json", '[{"id": 2, "v": "x"}]')
    put("torn.json", '[{"id": 3, "v": "x"')
    parts = load_split(spark, f"{tmp_path}/*.json", PAIR)
    assert values(parts.accepted) == [(2, "x")]
    assert sorted(r.motivo for r in parts.rejected.collect()) == ["json", "json"]


def test_json_lines_and_broken_lines(spark, put):
    path = put("l.jsonl", '{"id":1,"v":"a"}\n{"id":\n{"id":"x","v":"b"}\n')
    parts = load_split(spark, path, PAIR)
    assert values(parts.accepted) == [(1, "a")]
    assert sorted(r.motivo for r in parts.rejected.collect()) == ["json", "type:id"]


def test_several_files_of_which_some_are_absent(spark, put, tmp_path):
    put("saida0.csv", "id,v\n1,a\n")
    put("saida2.csv", "id,v\n2,b\n")
    path = any_of(str(tmp_path), [f"saida{i}.csv" for i in range(11)])
    assert values(read_delimited(spark, path, schema=PAIR).accepted) == [(1, "a"), (2, "b")]


def test_id_number_pairs(spark, put):
    path = put("pairs.csv", "id_hospital,Total\n1,2.5\nx,3,extra\n2,bad\n3\n")
    assert values(id_number_pairs(spark, path)) == [("1", 2.5), ("x", 3.0)]


@pytest.fixture
def database(tmp_path):
    path = tmp_path / "feed.db"
    con = sqlite3.connect(path)
    con.execute("create table pacientes (i integer, r real, s text, n)")
    con.execute("create table outra (x)")
    con.executemany(
        "insert into pacientes values (?, ?, ?, ?)",
        [
            (None, 1.0, "a", None),
            (1, 2.5, "b", b"zz"),
            ("txt", 3.0, "c", "k"),
            (2, 3, None, "k"),
            (3, 4.0, b"blob", 5),
        ],
    )
    con.execute("insert into outra values (1)")
    con.commit()
    con.close()
    return str(path)


def test_database_scan(spark, database):
    parts = read_database(spark, database, rows_per_partition=2)
    kinds = [f.dataType.simpleString() for f in parts.accepted.schema]
    assert kinds == ["bigint", "double", "string", "string"]
    assert values(parts.accepted) == [
        (None, 1.0, "a", None),
        (1, 2.5, "b", None),
        (2, 3.0, None, "k"),
    ]
    assert sorted(r.motivo for r in parts.rejected.collect()) == ["type:i", "type:n"]
    assert parts.accepted.rdd.getNumPartitions() == 3
    assert values(load(spark, database)) == [(1, 2.5, "b", None), (2, 3.0, None, "k")]


def test_database_table_by_name_and_schema(spark, database):
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    assert values(load(spark, database, schema, table="outra")) == [(1,)]


def test_database_without_tables(spark, tmp_path):
    path = tmp_path / "void.db"
    sqlite3.connect(path).execute("pragma user_version = 1").connection.close()
    with pytest.raises(Exception, match="no table found"):
        load(spark, str(path)).count()


def test_database_without_row_ids(spark, tmp_path):
    path = tmp_path / "keyed.db"
    con = sqlite3.connect(path)
    con.execute("create table t (k integer primary key, v text) without rowid")
    con.executemany("insert into t values (?, ?)", [(i, str(i)) for i in range(5)])
    con.commit()
    con.close()
    assert load(spark, str(path)).count() == 5


def test_jdbc_scan_is_partitioned():
    class Reader:
        def jdbc(self, url, table, **options):
            return url, table, options

    class Session:
        read = Reader()

    url, table, options = read_jdbc_table(Session(), "jdbc:x", "t", "id", 0, 100, 8, user="u")
    assert (url, table) == ("jdbc:x", "t")
    assert options["numPartitions"] == 8 and options["column"] == "id"
    assert options["properties"] == {"user": "u"}


def test_json_arrays_of_several_files_one_of_them_broken(spark, put, tmp_path):
    put("a.json", '[{"id":1,"v":"x"},\n {"id":2.5,"v":"y"},{"id":3,"v":[1,{"k":"z"}]}]')
    put("b.json", '\n[{"id":4,"v":"w"},')
    put("c.json", "[]")
    put("d.json", "")
    parts = load_split(spark, f"{tmp_path}/*.json", PAIR)
    assert values(parts.accepted) == [(1, "x"), (3, '[1,{"k":"z"}]')]
    assert values(parts.rejected) == [
        ("json", '\n[{"id":4,"v":"w"},'),
        ("type:id", '{"id":"2.5","v":"y"}'),
    ]
    assert parts.accepted.count() == 2 and parts.accepted.select("v").count() == 2


def test_each_file_has_its_own_header(spark, tmp_path):
    from tidefeed.sources import read_delimited

    (tmp_path / "a.csv").write_text("cep,num\n1,11\n2,12\n")
    (tmp_path / "b.csv").write_text("num,cep\n13,3\n14,4\n")
    (tmp_path / "c.csv").write_text("other,names\n5,6\n")
    (tmp_path / "d.csv").write_text("")
    schema = T.StructType([T.StructField("cep", T.IntegerType()), T.StructField("num", T.IntegerType())])
    parts = read_delimited(spark, f"{tmp_path}/*.csv", schema=schema)
    assert values(parts.accepted) == [(1, 11), (2, 12), (3, 13), (4, 14)]
    assert values(parts.rejected) == [("header", "5,6")]  # a header is never a row
    inferred = read_delimited(spark, f"{tmp_path}/[ab].csv").accepted
    assert values(inferred) == [(1, 11), (2, 12), (3, 13), (4, 14)]


def test_csv_round_trip(spark, rows, tmp_path):
    from tidefeed.sinks import write_csv
    from tidefeed.sources import read_delimited

    texts = [" a ", "", None, "x,y", 'say "hi"', "a\nb\r\nc", "\\n", "\\\\s\\", "tab\t"]
    df = rows("k int, t string", *enumerate(texts))
    assert write_csv(df, f"{tmp_path}/out", line_safe=True) == len(texts)
    parts = read_delimited(spark, f"{tmp_path}/out", schema=df.schema, line_safe=True)
    assert sorted((r.k, r.t) for r in parts.accepted.collect()) == list(enumerate(texts))
    assert parts.rejected.count() == 0


def test_row_ids_hidden_by_a_column(spark, tmp_path):
    import sqlite3

    db = sqlite3.connect(tmp_path / "t.db")
    db.execute("create table t (rowid text, v integer)")
    db.executemany("insert into t (_rowid_, rowid, v) values (?, ?, ?)", [(-5, None, 1), (3, "x", 2), (900, "7", 3), (2**63 - 1, None, 4)])
    db.execute("create table u (rowid int, oid int, _rowid_ int)")
    db.executemany("insert into u values (?, ?, ?)", [(None, 1, None), (2, None, 2)])
    db.commit()
    db.close()
    whole = read_database(spark, f"{tmp_path}/t.db").accepted
    cut = read_database(spark, f"{tmp_path}/t.db", rows_per_partition=2).accepted
    assert values(whole) == values(cut) and cut.count() == 4
    assert read_database(spark, f"{tmp_path}/t.db", table="u", rows_per_partition=1).accepted.count() == 2
    assert load(spark, f"{tmp_path}/*.db").count() == 4


def test_declaring_many_files_takes_as_many_jobs_as_declaring_few(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / f"of{n}"
        folder.mkdir()
        for i in range(n):
            (folder / f"f {i}.csv").write_text(f"\n{'id,v' if i % 2 else 'v,id'}\n{i},{i}\n")
        spark.sparkContext.setJobGroup(f"declare-{n}", "")
        parts = read_delimited(spark, f"{folder}/*.csv", schema=PAIR)
        spark.sparkContext.setJobGroup("rest", "")
        assert sorted(map(tuple, parts.accepted.collect())) == [(i, str(i)) for i in range(n)]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"declare-{n}"))

    assert jobs(80) == jobs(160)  # from 33 paths on Spark lists those of a reader in a job, too


def test_headers_of_files_in_many_splits(spark, tmp_path):
    for name in ("a", "b c"):
        (tmp_path / f"{name}.csv").write_text("id,v\n" + "".join(f"{i},{name}{i}\n" for i in range(4000)))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        parts = read_delimited(spark, f"{tmp_path}/*.csv", schema=PAIR)
        assert parts.accepted.rdd.getNumPartitions() > 10
        assert parts.accepted.count() == 8000 and parts.rejected.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_columns_named_like_the_readers_own(spark, put):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("line", "file", "value", "at")])
    parts = read_delimited(spark, put("names.csv", 'line,file,value,at\n1,2,3,4\n5,6\n7,"8\n'), schema=schema)
    assert values(parts.accepted) == [("1", "2", "3", "4")]
    assert values(parts.rejected) == [("arity", "5,6"), ("quote", '7,"8')]


def test_lines_with_an_open_quote_are_set_aside(spark, put):
    path = put("open.csv", 'id,v\n1,"a"\n2,"b\n3,c\n4,d"\n5,"e ""f"" \x01"\n6,"g,h\n')
    parts = load_split(spark, path, PAIR)
    assert values(parts.accepted) == [(1, "a"), (3, "c"), (5, 'e "f" \x01')]
    assert values(parts.rejected) == [("quote", '2,"b'), ("quote", '4,d"'), ("quote", '6,"g,h')]


@pytest.mark.parametrize("split", ["128m", "64"])
def test_fields_over_several_lines_come_out_whole(spark, put, tmp_path, split):
    text = '\n \nid,v\n\n1,"a\n\n3,""x"", \nb"\n2,plain\n4,"c\nd"\n5,"e",f\n6,"g\n7,h\n'
    long = "id,v\n" + "".join(f'{i},"{"word " * 20}\n{i}\n"\n' for i in range(10, 60)) + '8,"9"\n'
    put("a.csv", text)
    put("b.csv", long)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        parts = read_delimited(spark, f"{tmp_path}/*.csv", schema=PAIR, multi_line=True)
        got = {r.id: r.v for r in parts.accepted.collect()}
        assert got.pop(1) == 'a\n\n3,"x", \nb' and got.pop(2) == "plain" and got.pop(4) == "c\nd" and got.pop(8) == "9"
        assert got.pop(7) == "h"  # its line stands within the field that is never closed, and fits by itself
        assert got == {i: f"{'word ' * 20}\n{i}\n" for i in range(10, 60)}
        assert values(parts.rejected) == [("arity", '5,"e",f'), ("quote", '6,"g')]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_lines_of_foreign_files_by_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "b c.csv").write_text("p,q,r\n1,2,3\n1,2\n")
    (tmp_path / "d.csv").write_text('p,q\n1,"2,3"\n1,2,3\n1,"2\n')
    parts = read_delimited(spark, f"{tmp_path}/*.csv", schema=PAIR)
    assert values(parts.accepted) == [(1, "x")]
    assert values(parts.rejected) == sorted(
        [("arity", "1,2,3"), ("arity", "1,2"), ("header", '1,"2,3"'), ("arity", "1,2,3"), ("quote", '1,"2')]
    )


@pytest.mark.parametrize("split", ["128m", "50"])
def test_array_files_are_read_in_parts(spark, put, tmp_path, split):
    from tidefeed.sources import read_json

    hard = [
        {"id": 1, "v": "x"}, {"id": 2, "v": "} , { [ \\ \" } ]"}, {"id": 3, "v": {"k": [{"a": "}"}, {}]}}, {}, {"id": 4, "v": "é\n{"},
        {"v": "\\\\", "id": 5}, {"id": "bad", "v": None}, {"id": 6, "v": [[], [{"z": {"y": {}}}], "\\\""]},
    ]
    put("a.json", "\ufeff " + json.dumps(hard, ensure_ascii=False, indent=1) + "\n")
    put("b.json", json.dumps([{"id": i, "v": {"n": [i] * (i % 7)}} for i in range(100, 400)]))
    for name, text in (("c", "[ ]"), ("d", ""), ("e", '[{"id": 7}'), ("f", '{"id": 8}\n{"id": 9}'), ("g", '[{"id":1} {"id":2}]'), ("h", '[1, {"id":1}]')):
        put(f"{name}.json", text)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        parts = read_json(spark, f"{tmp_path}/*.json", PAIR, whole_bytes=0)
        got = {r.id: r.v for r in parts.accepted.collect()}
        bad = sorted(r.registro for r in parts.rejected.where("motivo = 'json'").collect())
        types = parts.rejected.where("motivo <> 'json'").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert got.pop(None) is None and len(types) == 1 and types[0].motivo == "type:id"
    want = {h["id"]: h["v"] for h in hard if isinstance(h.get("id"), int)} | {i: {"n": [i] * (i % 7)} for i in range(100, 400)}
    assert {i: v if isinstance(want[i], str) else json.loads(v) for i, v in got.items()} == want
    assert "".join(sorted(bad)) == "".join(sorted(['[{"id": 7}', '{"id": 8}', '\n{"id": 9}', '[{"id":1}', ' {"id":2}', "]", '[1, {"id":1}', "]"]))


def test_one_array_file_is_read_by_several_tasks_and_as_whole_texts_alike(spark, tmp_path):
    from tidefeed.sources import read_json

    (tmp_path / "one.json").write_text(json.dumps([{"id": i, "v": f"row {i}"} for i in range(5000)]))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        from tidefeed.sources.files import array_objects

        pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert pieces.rdd.getNumPartitions() > 5
        assert array_objects(spark, str(tmp_path)).where("not broken").count() == 5000
        split = read_json(spark, str(tmp_path / "one.json"), PAIR, whole_bytes=1000).accepted
        assert values(split) == values(read_json(spark, str(tmp_path / "one.json"), PAIR).accepted)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
