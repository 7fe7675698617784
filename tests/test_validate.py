import pytest
from conftest import values

from tidefeed.operators import Rule, check_rows, learn_rules, validate


def rule(df, name, **options):
    return next(r for r in learn_rules(df, **options) if r.column == name)


def test_rules_by_name(rows):
    df = rows(
        "cep_ilha int, cep_region string, idade int, percentage double, num_obitos int, "
        "populacao int, data string, other int"
    )
    rules = {r.column: r for r in learn_rules(df)}
    assert rules["cep_ilha"].digits == 2
    assert rules["cep_region"].digits == 5
    assert (rules["idade"].minimum, rules["idade"].maximum) == (0, 120)
    assert rules["percentage"].maximum == 120  # holds the letters of "age"
    assert (rules["num_obitos"].minimum, rules["num_obitos"].maximum) == (0, None)
    assert rules["populacao"].minimum == 0
    assert rules["data"].exempt
    assert rules["other"] == Rule("other")


def test_codes_are_learnt_from_five_rows_on(rows):
    four = rows("cep int", *[(i,) for i in range(11, 15)])
    assert rule(four, "cep").digits is None
    assert rule(rows("cep int", *[(i,) for i in range(11, 16)]), "cep").digits == 2
    assert rule(rows("cep int", *[(11000 + i,) for i in range(5)]), "cep").digits == 5
    assert rule(rows("cep int", *[(i,) for i in (11, 12, 13, 14, 11001)]), "cep").digits is None
    assert rule(rows("cep int", *[(i,) for i in (111, 112, 113, 114, 115)]), "cep").digits is None
    assert rule(rows("cep string", *[(str(i),) for i in range(11, 16)]), "cep").digits is None
    assert rule(rows("cep double", *[(float(i),) for i in range(11, 16)]), "cep").digits is None
    assert rule(rows("cep int", *[(i,) for i in (11, 12, 13, 14, None)]), "cep").digits is None


def test_booleans_are_learnt_from_five_rows_on(rows):
    assert rule(rows("f int", (0,), (1,), (0,), (1,), (1,)), "f").boolean
    assert not rule(rows("f int", (0,), (1,), (0,), (1,)), "f").boolean
    assert not rule(rows("f int", (0,), (1,), (2,), (1,), (1,)), "f").boolean
    assert rule(rows("f double", *[(1.0,)] * 5), "f").boolean
    assert not rule(rows("f string", *[("1",)] * 5), "f").boolean
    assert not rule(rows("idade int", *[(1,)] * 5), "idade").boolean


def test_only_the_first_rows_teach(rows):
    df = rows("n int, f int", *[(i, 1 if i < 20 else 7) for i in range(40)])
    assert rule(df, "f", order_by=["n"]).boolean
    assert not rule(df, "f", order_by=["n"], sample=21).boolean


@pytest.mark.parametrize(
    "ddl, rule, good, bad",
    [
        ("x int", Rule("x", digits=2), [10, 99, 0, None], [9, 100, -5, -15]),
        ("x bigint", Rule("x", digits=5), [10000, 99999, 0], [9999, 100000]),
        ("x string", Rule("x", digits=2), ["05", "", None], ["5", "5a", "055", "-5"]),
        ("x double", Rule("x", digits=2), [0.0, None], [11.0]),
        ("x int", Rule("x", boolean=True), [0, 1, None], [7, -1]),
        ("x double", Rule("x", boolean=True), [0.0, 1.0], [0.5]),
        ("x string", Rule("x", boolean=True), ["0", "1", "true", "false", ""], ["True", "2"]),
        ("x int", Rule("x", minimum=0, maximum=120), [0, 120, None], [-1, 121]),
        ("x int", Rule("x", minimum=0), [10**6, None], [-1]),
        ("x int", Rule("x"), [-5, 5], []),
        ("x string", Rule("x"), ["", None], ["text", "5"]),
        ("x string", Rule("x", minimum=0), [""], ["5"]),
        ("x string", Rule("x", exempt=True), ["text", ""], []),
    ],
)
def test_cells(rows, ddl, rule, good, bad):
    df = rows(ddl, *[(v,) for v in good + bad])
    parts = check_rows(df, [rule])
    assert values(parts.accepted) == values(rows(ddl, *[(v,) for v in good]))
    assert [r.motivo for r in parts.rejected.collect()] == ["invalid:x"] * len(bad)


def test_validate(rows):
    cells = [(11, i % 2, "01-01-2024", i) for i in range(20)]
    df = rows("cep int, f int, data string, n int", *cells, (111, 1, "x", 21), (12, 7, "", 22))
    parts = validate(df, order_by=["n"])
    assert parts.accepted.count() == 20
    assert values(parts.rejected.select("n", "motivo")) == [(21, "invalid:cep"), (22, "invalid:f")]
    assert parts.accepted.columns == df.columns


def test_validate_with_given_rules_and_empty_tables(rows):
    df = rows("f int", (1,), (7,))
    assert validate(df).accepted.count() == 2
    assert validate(df, rules=[Rule("f", boolean=True)]).accepted.count() == 1
    assert validate(df.limit(0)).accepted.count() == 0
    assert validate(rows("nota string, data string", ("x", "y"), ("", "y"))).accepted.count() == 1
    wide = rows("nota string", ("x",), ("",))
    assert validate(wide, exempt=("data", "nota")).accepted.count() == 2


@pytest.mark.parametrize("parts", [1, 8, 200])
def test_rules_of_all_rows_reject_strays_however_they_lie(rows, parts):
    cells = [(11 + i % 80, i % 2, 1.0, i % 2 if i % 10 else None) for i in range(1000)]
    df = rows("cep int, f int, d double, gaps int", *cells, (11001, 1, 1.0, 1), (12, 7, 0.0, 1), (13, None, 1.0, 1))
    found = validate(df.repartition(parts))
    assert values(found.rejected.select("cep", "f", "motivo")) == [(11001, 1, "invalid:cep"), (12, 7, "invalid:f")]
    assert not rule(df.repartition(parts), "gaps").boolean  # too many cells are missing
    assert not rule(df, "f", sample=2000).boolean and rule(df, "f", sample=500).boolean


def test_a_rule_needs_nearly_all_rows(rows):
    most = rows("f int", *[(1,)] * 19, (7,))
    assert rule(most, "f").boolean and rule(most, "f", sample=21).boolean is False
    assert not rule(rows("f int", *[(1,)] * 18, (7,)), "f").boolean
    assert rule(rows("cep int", *[(11000,)] * 19, (-5,)), "cep").digits == 5
