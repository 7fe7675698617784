import json
from pathlib import Path

import pytest
from conftest import values

from tidefeed.sinks import (
    as_json,
    write_csv,
    write_json,
    write_json_arrays,
    write_outputs,
)
from tidefeed.sources import load


def lines(folder):
    found = [f.read_text().splitlines() for f in sorted(Path(folder).glob("part-*"))]
    return [line for part in found for line in part]


def test_csv_has_a_header_and_six_decimals(rows, tmp_path):
    df = rows("cep string, Total_num_obitos double, Alertas string", ("20", 27285.0, "Vermelho"))
    write_csv(df.coalesce(1), f"{tmp_path}/oms")
    assert lines(tmp_path / "oms") == [
        "cep,Total_num_obitos,Alertas",
        "20,27285.000000,Vermelho",
    ]


def test_csv_round_trip_with_quotes(rows, spark, tmp_path):
    df = rows("id int, s string", (1, 'a,"b"'), (2, "c\\d"), (3, "plain"))
    path = f"{tmp_path}/q.csv"
    assert write_csv(df, path) == 3
    assert values(load(spark, path)) == values(df)
    assert write_csv(df.limit(1), path) == 1  # replaces what is there
    assert load(spark, path).count() == 1


def test_empty_output_warns(rows, tmp_path):
    with pytest.warns(UserWarning, match="empty"):
        assert write_csv(rows("a int"), f"{tmp_path}/none") == 0
    assert lines(tmp_path / "none") == ["a"]


def test_outputs_by_name(rows, spark, tmp_path):
    df = rows("id int, v double", (1, 2.0))
    counts = write_outputs({"hospital": df, "merge_AB": df.unionByName(df)}, str(tmp_path))
    assert counts == {"hospital": 1, "merge_AB": 2}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["hospital", "merge_AB"]
    assert write_outputs({}, str(tmp_path)) == {}


def test_json_text_escapes(rows):
    df = rows("i int, s string, n string", (1, 'q"b\\', None))
    text = df.select(as_json(df)).first()[0]
    assert text == '{"i":1,"s":"q\\"b\\\\","n":null}'


def test_json_files(rows, tmp_path):
    df = rows("i int, s string", *[(i, f"s{i}") for i in range(50)])
    write_json(df, f"{tmp_path}/l")
    assert sorted(json.loads(line)["i"] for line in lines(tmp_path / "l")) == list(range(50))
    write_json_arrays(df.repartition(3), f"{tmp_path}/a")
    files = [f for f in (tmp_path / "a").glob("part-*") if f.stat().st_size]
    arrays = [json.loads(f.read_text()) for f in files]
    assert len(arrays) == 3
    assert sorted(o["i"] for a in arrays for o in a) == list(range(50))


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_json_array_files_are_bounded(spark, rows, tmp_path, batch):
    df = rows("i int", *[(i,) for i in range(23)]).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        write_json_arrays(df, f"{tmp_path}/a.json", rows_per_file=5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = sorted((tmp_path / "a.json").glob("part-*"))
    arrays = [[o["i"] for o in json.loads(f.read_text())] for f in files]
    assert sorted(map(len, arrays)) == [3, 5, 5, 5, 5]
    assert values(load(spark, f"{tmp_path}/a.json")) == values(df)
    write_json_arrays(df.limit(0), f"{tmp_path}/none")
    assert not any(f.stat().st_size for f in (tmp_path / "none").glob("part-*"))


def test_guards_name_the_columns(rows, spark, tmp_path):
    from tidefeed.operators import require_columns, require_numeric
    from tidefeed.sinks import audit_outputs
    from tidefeed.sources import audit_files

    df = rows("id int, s string", (1, "a"))
    with pytest.raises(ValueError, match=r"missing column\(s\): nada, mais"):
        require_columns(df, "id", "nada", "mais")
    with pytest.raises(ValueError, match="column s is not numeric"):
        require_numeric(df, "s")
    found = audit_outputs({"good": df, "bad": df.drop("id"), "none": df.limit(0)}, f"{tmp_path}/out", ["id"], ["id"])
    assert sorted(map(tuple, found.collect())) == [("bad", None, None, "id", ""), ("good", 1, False, "", ""), ("none", 0, True, "", "")]
    assert not (tmp_path / "out" / "bad").exists()
    (tmp_path / "in").mkdir()
    for name, text in (("a b.csv", "x\n1\n\n2\n"), ("c.csv", ""), ("d.csv", " \nx\n")):
        (tmp_path / "in" / name).write_text(text)
    audit = audit_files(spark, f"{tmp_path}/in").select("bytes", "header", "rows", "fault")
    assert values(audit) == values(
        rows("bytes long, header string, rows long, fault string", (7, "x", 2, None), (0, None, 0, "no header"), (4, "x", 0, "no rows"))
    )
