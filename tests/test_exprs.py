from conftest import values
from pyspark.sql import functions as F

from tidefeed.functions import (
    as_number,
    as_text,
    fmt6,
    island_code,
    island_key,
    join_or,
    norm_key,
    null_like,
    null_tokens,
    only_digits,
)


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_island_code_of_text(rows):
    df = rows("c string", ("1",), ("11",), ("11001",), ("-5",), ("12-345",), ("",), (None,), ("ab",))
    assert column(df, island_code(df, "c")) == ["01", "11", "11", "05", "12", "00", "00", "00"]


def test_island_code_of_numbers(rows):
    df = rows("i int, d double", (5, 12345.9), (-11001, -7.2), (0, 0.4), (None, float("nan")))
    assert column(df, island_code(df, "i")) == ["05", "11", "00", "00"]
    assert column(df, island_code(df, "d")) == ["12", "07", "00", "00"]


def test_island_key(rows):
    df = rows("s string, i int", ("05", 5), ("11001", -11001), ("x", 0), (None, None))
    assert column(df, island_key(df, "s")) == [5, 11, 0, 0]
    assert column(df, island_key(df, "i")) == [5, 11, 0, 0]


def test_norm_key(rows):
    df = rows(
        "s string, d double, i int",
        ("12abc", 3.9, 1),
        (" +7", -3.9, -2),
        ("3.7", 1e30, 3),
        ("abc", float("nan"), None),
        ("99999999999999999999", None, 5),
        ("", 0.0, 0),
    )
    assert column(df, norm_key(df, "s")) == [12, 7, 3, None, None, None]
    assert column(df, norm_key(df, "d")) == [3, -3, None, None, None, 0]
    assert column(df, norm_key(df, "i")) == [1, -2, 3, None, 5, 0]


def test_null_like_counts_zero_and_empty(rows):
    df = rows(
        "s string, i int, d double, b boolean",
        ("", 0, -0.0, False),
        (None, None, None, None),
        (" ", 1, 0.1, True),
    )
    found = {n: column(df, null_like(df, n)) for n in df.columns}
    assert found["s"] == found["i"] == found["d"] == [True, True, False]
    assert found["b"] == [False, True, False]


def test_text_forms(rows):
    df = rows("d double, i int, s string", (1.5, 7, "x"), (None, None, None))
    assert column(df, fmt6(F.col("d"))) == ["1.500000", None]
    assert column(df, as_text(df, "d")) == ["1.500000", None]
    assert column(df, as_text(df, "i")) == ["7", None]


def test_text_has_no_number(rows):
    df = rows("i int, s string", (7, "7"))
    assert column(df, as_number(df, "i")) == [7.0]
    assert column(df, as_number(df, "s")) == [None]


def test_null_tokens(rows):
    df = rows("s string", ("",), ("null",), ("NULL",), ("NaN",), ("nan",), (None,), ("x",))
    assert column(df, null_tokens(F.col("s"))) == [None, None, None, None, "nan", None, "x"]


def test_only_digits(rows):
    df = rows("s string", ("12",), ("1",), ("1a",), ("12\n",), ("٣٤",))
    assert column(df, only_digits(F.col("s"), 2)) == [True, False, False, False, False]


def test_join_or(rows):
    df = rows("a array<string>", (["b", "a"],), ([],), (None,))
    assert column(df, join_or(F.col("a"))) == ["a, b", "(nenhum)", "(nenhum)"]


def test_names_with_dots_and_spaces(rows):
    df = rows("`Total.x y` double", (0.0,), (2.0,))
    assert column(df, null_like(df, "Total.x y")) == [True, False]
    assert values(df.select(as_text(df, "Total.x y")))[1] == ("2.000000",)
