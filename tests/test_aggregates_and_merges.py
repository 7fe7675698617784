import math

import pytest
from conftest import values

from tidefeed import operators as op

# Totals per island, and which of them are above the mean of 25038.2.
ISLANDS = {
    11: 19794, 12: 14176, 13: 30332, 14: 29659, 15: 21908, 16: 31301, 17: 16324, 18: 27595,
    19: 17051, 20: 27285, 21: 22389, 22: 27700, 23: 28784, 24: 29842, 25: 27768, 26: 26042,
    27: 26607, 28: 26567, 29: 25562, 30: 24078,
}
GREEN = [11, 12, 15, 17, 19, 21, 30]


@pytest.fixture
def islands(rows):
    return rows("cep int, num_obitos int", *[(k, part) for k, v in ISLANDS.items() for part in (v - 7, 7)])


def test_alerts_of_known_totals(islands):
    totals = op.group_sum(islands, "cep", "num_obitos")
    assert [f.dataType.simpleString() for f in totals.schema] == ["string", "double"]
    flagged = op.mean_alert(totals, "Total_num_obitos")
    assert flagged.columns == ["cep", "Total_num_obitos", "Alertas"]
    assert op.column_mean(totals, "Total_num_obitos").first()[0] == pytest.approx(25038.2)
    found = {int(r.cep): r.Alertas for r in flagged.collect()}
    assert found == {k: "Verde" if k in GREEN else "Vermelho" for k in ISLANDS}
    summary = op.alert_summary(flagged, "cep").first()
    assert summary.verde == "11, 12, 15, 17, 19, 21, 30"
    assert summary.vermelho == ", ".join(str(k) for k in ISLANDS if k not in GREEN)


def test_keys(rows):
    df = rows("k string, v int", ("1", 1), ("1.9", 2), ("1x", 3), ("x", 4), (None, 5), ("2", None))
    assert values(op.group_sum(df, "k", "v")) == [("1", 6.0), ("2", 0.0)]
    parts = op.split_keys(df, "k")
    assert parts.accepted.count() == 4
    assert values(parts.rejected) == [(None, 5, "key:k"), ("x", 4, "key:k")]


def test_island_keys(rows):
    df = rows("cep int, v int", (5, 1), (11001, 2), (11002, 3), (-11003, 4), (None, 5))
    assert values(op.group_sum_island(df, "cep", "v")) == [("11", 9.0), ("5", 1.0)]
    text = rows("cep string, v int", ("05", 1), ("5", 2), ("x11", 3), ("11-x", 4))
    assert values(op.group_sum_island(text, "cep", "v")) == [("11", 4.0), ("5", 3.0)]


def test_group_errors(rows):
    df = rows("k int, s string", (1, "2"))
    with pytest.raises(ValueError):
        op.group_sum(df, "absent", "k")
    with pytest.raises(ValueError):
        op.group_sum(df, "k", "absent")
    with pytest.raises(ValueError, match="numeric"):
        op.group_sum(df, "k", "s")
    assert values(op.group_sum_text(df, "k", "s")) == [("1", 2.0)]


def test_totals_add_up_on_any_number_of_partitions(rows):
    df = rows("k int, v int", *[(i % 7 if i % 3 else 0, i) for i in range(1000)])
    expected = values(op.group_sum(df.coalesce(1), "k", "v"))
    assert values(op.group_sum(df.repartition(16), "k", "v")) == expected
    assert sum(r[1] for r in expected) == op.column_sum(df, "v").first()[0] == sum(range(1000))


def test_column_totals(rows):
    df = rows("v string, n double", ("1.5", 1.0), ("x", None), (None, 3.0))
    assert op.column_sum(df, "v").first()[0] == 1.5
    assert op.column_mean(df, "n").first()[0] == pytest.approx(4 / 3)
    assert op.column_sum(df.limit(0), "n").first()[0] == 0.0
    assert op.column_mean(df.limit(0), "n").first()[0] is None


def test_alert_edges(rows):
    equal = op.mean_alert(rows("v double", (2.0,), (2.0,)), "v")
    assert {r.Alertas for r in equal.collect()} == {"Verde"}
    assert op.mean_alert(rows("v double", (5.0,)), "v").first().Alertas == "Verde"
    # a missing value is below the mean, but its row counts in the mean: (0 + 3) / 3 = 1 < 3
    gaps = op.mean_alert(rows("v double", (None,), (0.0,), (3.0,)), "v")
    assert values(gaps) == [(None, "Verde"), (0.0, "Verde"), (3.0, "Vermelho")]
    assert op.mean_alert(rows("v double"), "v").count() == 0
    with pytest.raises(ValueError):
        op.mean_alert(rows("v string"), "v")


def test_alert_summary_edges(spark, rows):
    df = rows("cep string, Alertas string", ("2", "Verde"), ("10", "Verde"), ("10", "Verde"), ("3", "?"))
    assert tuple(op.alert_summary(df, "cep").first()) == ("(nenhum)", "02, 10")
    assert values(op.alert_rows(df, "cep")) == [("Verde", "10"), ("Verde", "2")]
    with pytest.raises(ValueError, match="missing"):
        op.alert_summary(df, "CEP2")
    many = spark.range(10000, 260000).selectExpr("cast(id as string) cep", "'Verde' Alertas")
    assert op.alert_summary(many, "cep").first().verde == ", ".join(str(k) for k in range(10, 100))
    assert op.alert_rows(many, "cep").count() == 250000


def test_stats(rows):
    df = rows("id string, v double", ("2", 1.0), ("10", 5.0), ("2", 3.0), ("x", 9.0), ("10", None))
    n, mean, deviation = op.stats(df, "v").first()
    assert (n, mean) == (4, 4.5)
    assert deviation == pytest.approx(math.sqrt((3.5**2 + 0.5**2 + 1.5**2 + 4.5**2) / 4))
    assert [tuple(r) for r in op.stats_by(df, "id", "v").collect()] == [(2, 2.0, 1.0), (10, 5.0, 0.0)]
    assert tuple(op.stats(df.limit(0), "v").first()) == (0, None, None)


def test_correlation_and_line(rows):
    df = rows("x double, y double", (1.0, 2.0), (2.0, 4.5), (3.0, 6.0), (None, 100.0), (50.0, None))
    x, y = [1, 2, 3], [2, 4.5, 6]
    mx, my = 2, sum(y) / 3
    sxy = sum((a - mx) * (b - my) for a, b in zip(x, y))
    sxx, syy = sum((a - mx) ** 2 for a in x), sum((b - my) ** 2 for b in y)
    assert op.pearson(df, "x", "y").first()[0] == pytest.approx(sxy / math.sqrt(sxx * syy))
    intercept, slope = op.linreg(df, "x", "y").first()
    assert slope == pytest.approx(sxy / sxx)
    assert intercept == pytest.approx(my - slope * mx)


def test_correlation_edges(rows):
    for pairs in ([(0.1, 1.0), (0.1, 2.0), (0.1, 5.0)], [(1.0, 2.0)], [(None, 1.0)], []):
        df = rows("x double, y double", *pairs)
        assert op.pearson(df, "x", "y").first()[0] is None
        assert tuple(op.linreg(df, "x", "y").first()) == (None, None)
    with pytest.raises(ValueError):
        op.pearson(rows("x double"), "x", "absent")


def test_lookup(rows):
    left = rows("cep string, a double", ("5", 1.0), ("11", 2.0), ("11", 3.0), ("99", 4.0))
    right = rows("cep int, v double", (5, 10.0), (11001, 20.0), (11002, 21.0))
    joined = op.lookup_join(left, right, "cep", "v", "_B")
    assert joined.columns == ["cep", "a", "v_B"]
    assert values(joined) == [
        ("11", 2.0, 21.0),
        ("11", 3.0, 21.0),
        ("5", 1.0, 10.0),
        ("99", 4.0, 0.0),
    ]
    unfilled = op.lookup_join(left, right, "cep", "v", "_B", fill=None)
    assert values(unfilled.where("cep = '99'")) == [("99", 4.0, None)]


def test_lookup_takes_the_last_row_in_a_given_order(rows):
    left = rows("cep int", (11,))
    right = rows("cep int, v string, t int", (11, "late", 2), (11, "early", 1), (11999, "first", 0))
    assert op.lookup_join(left, right, "cep", "v", "_B", order_by="t").first()["v_B"] == "late"


def test_lookup_keeps_every_left_row_under_a_hot_code(rows):
    left = rows("cep int, n int", *[(11 if i % 3 == 0 else i, i) for i in range(900)])
    right = rows("cep int, v int", *[(11, i) for i in range(50)])
    assert op.lookup_join(left, right, "cep", "v", "_B").count() == 900


def test_three_way_merge(rows):
    a = rows("cep string, Total_internado double", ("11", 1.0), ("12", 2.0))
    b = rows("cep string, Total_num_obitos double", ("11", 10.0), ("13", 30.0))
    c = rows("cep string, Total_vacinado double", ("11", 100.0), ("13", 300.0))
    merged = op.merge_three(a, b, c, "cep", "Total_num_obitos", "Total_vacinado")
    assert list(merged) == ["AB", "ABC", "AC", "BC"]
    assert merged["ABC"].columns == [
        "cep",
        "Total_internado",
        "Total_num_obitos_B",
        "Total_vacinado_C",
    ]
    assert values(merged["ABC"]) == [("11", 1.0, 10.0, 100.0), ("12", 2.0, 0.0, 0.0)]
    assert values(merged["AB"]) == [("11", 1.0, 10.0), ("12", 2.0, 0.0)]
    assert values(merged["AC"]) == [("11", 1.0, 100.0), ("12", 2.0, 0.0)]
    assert values(merged["BC"]) == [("11", 10.0, 100.0), ("13", 30.0, 300.0)]
    with pytest.raises(ValueError):
        op.merge_three(a, b, c.drop("cep"), "cep", "Total_num_obitos", "Total_vacinado")
