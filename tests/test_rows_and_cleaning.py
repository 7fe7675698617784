import pytest
from conftest import values
from pyspark.sql import functions as F

from tidefeed import operators as op
from tidefeed.operators import table as table_ops


def test_required_columns_and_types(rows):
    df = rows("a int, s string", (1, "x"))
    op.require_columns(df, "a", "s")
    with pytest.raises(ValueError, match="z"):
        op.require_columns(df, "a", "z")
    with pytest.raises(ValueError, match="numeric"):
        op.require_numeric(df, "s")


def test_typed_rows(rows):
    parts = op.typed_rows(rows("i int, d double, s string", (1, None, "a"), (None, None, "b"), (2, 1.0, None)))
    assert values(parts.accepted) == [(2, 1.0, None)]
    assert values(parts.rejected.select("s", "motivo")) == [("a", "missing:d"), ("b", "missing:i")]
    text = op.typed_rows(rows("s string", (None,), ("x",)))
    assert text.accepted.count() == 2 and text.rejected.count() == 0


def test_age_filter_keeps_zero_and_drops_missing(rows):
    df = rows("idade int", (-1,), (0,), (120,), (121,), (None,))
    assert values(op.age_filter(df, "idade")) == [(0,), (120,)]
    assert values(op.age_filter(df, "idade", 200)) == [(0,), (120,), (121,)]
    assert op.age_filter(df, "absent") is df
    assert op.age_filter(rows("idade string", ("5",)), "idade").count() == 0


def test_threshold_flag(rows):
    df = rows("v double", (1.0,), (2.0,), (3.0,), (None,))
    flagged = op.threshold_flag(df, "v", 2.0, "f")
    assert values(flagged) == [(None, "False"), (1.0, "False"), (2.0, "False"), (3.0, "True")]


def test_append_rows(rows):
    df = rows("k bigint, s string", (1, "a"))
    batch = rows("s string, k string", ("b", "2"), ("c", "x"), ("d", None), (None, "3"))
    assert values(op.append_rows(df, batch)) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError):
        op.append_rows(df, rows("k int", (1,)))


@pytest.mark.parametrize("broadcast_limit", [-1, 1_000_000])
def test_drop_keys(rows, monkeypatch, broadcast_limit):
    monkeypatch.setattr(table_ops, "BROADCAST_BYTES", broadcast_limit)
    hot = [(7, i) for i in range(300)] + [(i, i) for i in range(5)]
    df = rows("k int, v int", *hot)
    keys = rows("k int, other string", (7, "a"), (7, "b"), (3, "c"), (99, "d"))
    assert values(op.drop_keys(df, keys, "k")) == [(0, 0), (1, 1), (2, 2), (4, 4)]


def test_columns(rows):
    df = rows("a int, b int", (1, 2))
    assert op.remove_column(df, "absent").columns == ["a", "b"]
    assert op.remove_column(df, "b").columns == ["a"]
    assert values(op.add_column(df, "c", F.col("a") + F.col("b"))) == [(1, 2, 3)]
    assert values(op.keep_rows(df, F.col("a") > 1)) == []


def test_duplicates(rows):
    df = rows("a int, b string", (1, "x"), (1, "x"), (1, "y"), (None, None), (None, None))
    assert values(op.drop_duplicate_rows(df)) == [(None, None), (1, "x"), (1, "y")]


def hundred(zeros):
    return [(i + 1, 0 if i < zeros else 5) for i in range(100)]


def test_sparse_columns_at_the_limit(rows):
    assert op.drop_sparse_columns(rows("i int, z int", *hundred(90))).columns == ["i"]
    assert op.drop_sparse_columns(rows("i int, z int", *hundred(89))).columns == ["i", "z"]
    assert op.drop_sparse_columns(rows("i int, z int", *hundred(95)), keep=["z"]).columns == ["i", "z"]


def test_sparse_columns_of_few_rows(rows):
    empty = rows("a int, b int")
    assert op.drop_sparse_columns(empty).columns == ["a", "b"]
    assert op.drop_sparse_columns(rows("a int, b int", (0, 0))).columns == ["a", "b"]
    # int(2 * 0.9) is 1, so a single missing cell of two is enough
    assert op.drop_sparse_columns(rows("a int, b int", (1, 0), (2, 3))).columns == ["a"]


def test_sparse_columns_of_each_type(rows):
    many = [(f"x{i}", None, "", 0.0) for i in range(10)]
    assert op.drop_sparse_columns(rows("s string, n string, e string, d double", *many)).columns == ["s"]


def test_sparse_rows(rows):
    df = rows("a int, b string, c double", (0, "", 1.0), (0, "", 0.0), (1, "x", 1.0), (0, None, None))
    assert op.drop_sparse_rows(df, 0.9).count() == 1  # int(3 * 0.9) = 2 missing cells drop a row
    assert op.drop_sparse_rows(df, 1.0).count() == 2
    assert values(op.drop_sparse_rows(rows("a int", (1,), (0,)))) == [(1,)]


@pytest.mark.parametrize("dedupe", [True, False])
def test_clean_is_idempotent_and_independent_of_partitions(rows, dedupe):
    df = rows("i int, z int, t string", *[(i % 60, i % 60 // 57, "t") for i in range(100)])
    once = op.clean(df.repartition(7), dedupe=dedupe)
    assert once.columns == ["i", "t"]
    assert once.count() == (60 if dedupe else 100)
    assert values(op.clean(once, dedupe=dedupe)) == values(once)
    assert values(op.clean(df.coalesce(1), dedupe=dedupe)) == values(once)


def test_clean_counts_missing_cells_of_distinct_rows(rows):
    # one row, copied fifty times, has the only zeros
    df = rows("i int, z int", *([(0, 0)] * 50 + [(i, i) for i in range(1, 6)]))
    assert op.clean(df).columns == ["i", "z"]
    assert op.clean(df, dedupe=False).columns == []
    assert op.clean(df.limit(0)).columns == ["i", "z"]
    assert values(op.clean(rows("a int, b int", (0, 0), (1, 2), (3, 4)), sparse_rows=True)) == [
        (1, 2),
        (3, 4),
    ]


def test_align_column(rows):
    df = rows("k int, a string, v int", (1, "x", 0), (2, "y", 0), (2, "z", 0), (3, "w", 0), (None, "n", 0), (5, "q", 0))
    given = rows("k int, v int, b int", (1, 10, 0), (2, 20, 0), (3, None, 0), (4, 40, 0), (None, 9, 0), (5, 1, 0), (5, 2, 0))
    parts = op.align_column(df, given, "v", "k")
    assert parts.accepted.columns == ["k", "a", "v"]
    assert values(parts.accepted) == values(rows("k int, a string, v int", (1, "x", 10), (3, "w", None)))
    assert values(parts.rejected) == values(
        rows(
            "k int, a string, v int, motivo string",
            (2, "y", None, "repeated"), (2, "z", None, "repeated"), (None, "n", None, "unmatched"),
            (5, "q", None, "repeated"), (4, None, 40, "unused"), (None, None, 9, "unused"),
        )
    )
    assert op.align_column(df.limit(0), given.limit(0), "v", "k").marked.count() == 0


def test_aligned_refuses_what_does_not_fit(rows):
    df, given = rows("k int, a int", (1, 1), (2, 2)), rows("k int, v int", (2, 20), (1, 10))
    assert values(op.aligned(df, given, "v", "k")) == [(1, 1, 10), (2, 2, 20)]
    with pytest.raises(ValueError, match="1 of 2 rows, the first unmatched"):
        op.aligned(df, given.where("k = 1"), "v", "k")
    with pytest.raises(ValueError, match="1 of 3 rows, the first unused"):
        op.aligned(df, given.unionAll(rows("k int, v int", (7, 7))), "v", "k")
