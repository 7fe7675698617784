import pytest
from conftest import values
from pyspark.sql import functions as F

from tidefeed import operators as op
from tidefeed.plans import weekly
from tidefeed.schemas import HOSPITAL, OMS, SECRETARIA, TAGGED_UNION
from tidefeed.sources import load
from tidefeed.storage import shared_root

DAY = "01-02-2024"


def test_origin_by_name_and_precedence(rows):
    names = ["x_oms_hospital.csv", "oms_secretaria", "secretaria.db", "OMS.txt", ""]
    df = rows("f string", *[(n,) for n in names], (None,))
    parts = op.by_origin(df, F.col("f"))
    assert values(parts.accepted) == [
        ("oms_secretaria", "oms"),
        ("secretaria.db", "secretaria"),
        ("x_oms_hospital.csv", "hospital"),
    ]
    assert parts.rejected.count() == 3


def test_origin_of_real_files(spark, tmp_path):
    for name in ("oms_1", "hospital_1"):
        (tmp_path / f"{name}.csv").write_text("v\n1\n2\n")
    df = spark.read.option("header", True).csv(str(tmp_path))
    routed = op.by_origin(df).accepted
    assert values(routed.groupBy("origem").count()) == [("hospital", 2), ("oms", 2)]
    op.write_by_origin(routed, f"{tmp_path}/routed")
    assert spark.read.parquet(f"{tmp_path}/routed/origem=oms").count() == 2


def test_allow_list(rows):
    parts = op.allow_list(rows("origem string", ("OMS",), ("Hospital",), ("outra",), (None,)))
    assert values(parts.accepted) == [("hospital",), ("oms",)]
    assert values(parts.rejected) == [(None, "origem:refused"), ("outra", "origem:refused")]


def test_tagged_union(spark):
    oms = (1, 2, 11, 3, 4, DAY)
    hospital = (1, DAY, 1, 30, 0, 11001, 0, 1, 0, 1)
    records = spark.createDataFrame(
        [
            ("OMS", "a", oms, None, None),
            ("hospital", "b", None, hospital, None),
            ("hospital", "b", oms, None, None),
            ("secretaria", "c", None, None, None),
            ("clinica", "d", oms, None, None),
        ],
        TAGGED_UNION,
    )
    parts = op.check_union(records)
    assert sorted(r.motivo for r in parts.rejected.collect()) == [
        "linha:mismatch",
        "linha:mismatch",
        "origem:refused",
    ]
    tables = op.split_union(parts.accepted)
    assert values(tables["linha_oms"]) == [oms]
    assert values(tables["linha_hospital"]) == [hospital]
    assert tables["linha_secretaria"].count() == 0
    assert tables["linha_oms"].columns == OMS.names
    assert values(op.listed_fields(tables["linha_hospital"], "hospital")) == [(1, DAY)]


@pytest.fixture
def week(spark):
    """Five islands; the hospital feed holds an age and a code at fault, all feeds hold a copy."""
    oms = [(10 * i, 1000 + i, 10 + i, i, i, DAY) for i in range(1, 6)]
    hospital = [
        (1 + i % 2, DAY, i % 2, 20 + i, i % 2, (11 + i % 5) * 1000 + 1, 0, 1, i % 2, 1)
        for i in range(20)
    ]
    at_fault = [(1, DAY, 1, 121, 0, 11001, 0, 1, 0, 1), (2, DAY, 1, 50, 0, 111, 0, 1, 0, 1)]
    secretaria = [(1, i % 2, (11 + i % 4) * 1000 + 2, 3, 1000 + i, DAY) for i in range(20)]
    return {
        "oms": spark.createDataFrame([*oms, oms[0]], OMS),
        "secretaria": spark.createDataFrame([*secretaria, secretaria[1]], SECRETARIA),
        "hospital": spark.createDataFrame([*hospital, *at_fault, hospital[1]], HOSPITAL),
    }


def test_weekly_run(spark, week, tmp_path):
    rules = op.learn_rules(week["hospital"].where("idade <= 120 and cep > 999"))
    treated = weekly.treat(week["hospital"], ["cep"], rules=rules)
    assert treated.count() == 20
    # Else the short code may be among the first rows, which leaves no code rule.
    outputs = weekly.run(**week, base=str(tmp_path), per_feed={"hospital": {"rules": rules}})
    assert list(outputs) == [
        "hospital",
        "oms",
        "secretaria",
        "merge_AB",
        "merge_ABC",
        "merge_AC",
        "merge_BC",
    ]
    assert values(outputs["oms"]) == [
        ("11", 10.0, "Verde"),
        ("12", 20.0, "Verde"),
        ("13", 30.0, "Verde"),
        ("14", 40.0, "Vermelho"),
        ("15", 50.0, "Vermelho"),
    ]
    assert values(outputs["secretaria"]) == [
        ("11", 0.0),
        ("12", 5.0),
        ("13", 0.0),
        ("14", 5.0),
    ]
    # The merge takes the other two feeds as received: with the copies.
    assert values(outputs["merge_BC"]) == [
        ("11", 20.0, 0.0),
        ("12", 20.0, 6.0),
        ("13", 30.0, 0.0),
        ("14", 40.0, 5.0),
        ("15", 50.0, 0.0),
    ]
    islands = {r.cep: r.Total_internado for r in outputs["merge_AC"].collect()}
    assert islands == {c: 2.0 for c in ("11", "12", "13", "14", "15")}
    assert values(outputs["hospital"]) == [("1", 0.0), ("2", 10.0)]
    written = load(spark, f"{tmp_path}/oms/*.csv")
    assert written.count() == 5 and written.columns == ["cep", "Total_num_obitos", "Alertas"]


def test_weekly_report(week):
    report = weekly.report(weekly.run(**week))
    assert [tuple(r) for r in report["alertas"].collect()] == [
        ("Verde", "11"),
        ("Verde", "12"),
        ("Verde", "13"),
        ("Vermelho", "14"),
        ("Vermelho", "15"),
    ]
    assert report["estatisticas"].first().registros == 2
    assert [r.id_hospital for r in report["estatisticas_por_hospital"].collect()] == [1, 2]
    assert -1 <= report["correlacao"].first()[0] <= 1
    assert report["regressao"].columns == ["intercepto", "coeficiente"]


def test_a_sparse_measure_is_kept(spark, week):
    quiet = week["hospital"].withColumn("internado", F.lit(0))
    outputs = weekly.run(week["oms"], week["secretaria"], quiet)
    assert {r.Total_internado for r in outputs["hospital"].collect()} == {0.0}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
