"""Validation rules: learnt from column names and the values, then checked on every row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.functions import as_number, col, null_like, only_digits, type_of
from tidefeed.operators.table import Split, all_of, split

# The words that decide a column's rule, matched in its lower-cased name.
CODE_WORDS = ("cep",)
ISLAND_WORDS = ("ilha", "island")
REGION_WORDS = ("região", "region", "bairro")
AGE_WORDS = ("idade", "age")
COUNT_WORDS = ("óbitos", "obitos", "death", "população", "populacao", "population")
EXEMPT_NAMES = ("data",)

# Code lengths, the age limit, texts of a boolean, sample sizes.
ISLAND_DIGITS = 2
REGION_DIGITS = 5
MAX_AGE = 120
BOOLEAN_TEXTS = ("0", "1", "false", "true")
SAMPLE_ROWS = 20
MIN_SAMPLE_ROWS = 5


@dataclass(frozen=True)
class Rule:
    """What a cell of one column must satisfy, unless it is missing."""

    column: str
    exempt: bool = False
    digits: int | None = None
    boolean: bool = False
    minimum: float | None = None
    maximum: float | None = None


def _named(name: str, words: Sequence[str]) -> bool:
    return any(word in name.lower() for word in words)


def _named_code_length(name: str) -> int | None:
    if _named(name, ISLAND_WORDS):
        return ISLAND_DIGITS
    return REGION_DIGITS if _named(name, REGION_WORDS) else None


def _asks_sample(df: DataFrame, name: str) -> bool:
    """Whether a column's name leaves its rule to the data. Text never matches a rule of the data."""
    if not isinstance(type_of(df, name), T.NumericType):
        return False
    open_code = _named(name, CODE_WORDS) and _named_code_length(name) is None
    return open_code or not _named(name, AGE_WORDS + COUNT_WORDS)


def learn_rules(
    df: DataFrame,
    sample: int = SAMPLE_ROWS,
    order_by: Sequence[str] | None = None,
    exempt: Sequence[str] = EXEMPT_NAMES,
) -> list[Rule]:
    """One rule per column, from its name and, where the name does not tell, from the values.

    With ``order_by`` a rule of the values is one that the first ``sample`` rows in that order all meet.
    Without, it is one that all rows but one in ``sample`` meet, so few enough strays do not
    keep a rule from being learnt and are rejected by it. Either way the rules do not depend on how the
    table is partitioned, and a single row of evidence comes to the driver.
    """
    source = df.orderBy(*map(col, order_by)).limit(sample) if order_by else df
    evidence = rule_evidence(df)
    seen = source.agg(*evidence).first().asDict() if evidence else {}
    return rules_from(df, seen, exempt, None if order_by else sample)


def rule_evidence(df: DataFrame) -> list[Column]:
    """Aggregates over the columns whose names leave their rule to the values: how many rows there are, and how many
    of them meet each rule that may be learnt. Counts add up over partitions; a missing cell meets none."""
    out = []
    for i, name in enumerate(df.columns):
        if not _asks_sample(df, name):
            continue
        out += [
            F.count(F.lit(1)).alias(f"e{i}_rows"),
            F.count_if(as_number(df, name).isin(0.0, 1.0)).alias(f"e{i}_boolean"),
            *(F.count_if(_of_width(df, name, n)).alias(f"e{i}_{n}") for n in (ISLAND_DIGITS, REGION_DIGITS)),
        ]
    return out


def _of_width(df: DataFrame, name: str, digits: int) -> Column:
    if not isinstance(type_of(df, name), T.IntegralType):
        return F.lit(False)  # the text form of a fraction is never all digits
    return col(name).between(10 ** (digits - 1), 10**digits - 1)


def rules_from(
    df: DataFrame, seen: Mapping, exempt: Sequence[str] = EXEMPT_NAMES, one_in: int | None = SAMPLE_ROWS
) -> list[Rule]:
    """One rule per column, given the values of ``rule_evidence``. A rule is learnt from values if all rows
    meet it but one in ``one_in``, or all of them without this number."""

    def met(i: int) -> dict:
        rows = seen.get(f"e{i}_rows") or 0
        counts = {k: seen.get(f"e{i}_{k}") or 0 for k in ("boolean", ISLAND_DIGITS, REGION_DIGITS)}
        return {k: rows >= MIN_SAMPLE_ROWS and (rows - n) * (one_in or rows + 1) <= rows for k, n in counts.items()}

    return [_rule(df, name, met(i), exempt) for i, name in enumerate(df.columns)]


def _rule(df: DataFrame, name: str, met: Mapping, exempt: Sequence[str]) -> Rule:
    if name.lower() in exempt:
        return Rule(name, exempt=True)

    digits = None
    if _named(name, CODE_WORDS):
        learnt = next((n for n in (ISLAND_DIGITS, REGION_DIGITS) if met[n]), None)
        digits = _named_code_length(name) or learnt

    if _named(name, AGE_WORDS):
        return Rule(name, digits=digits, minimum=0, maximum=MAX_AGE)
    if _named(name, COUNT_WORDS):
        return Rule(name, digits=digits, minimum=0)
    return Rule(name, digits=digits, boolean=met["boolean"])


def valid_cell(df: DataFrame, rule: Rule) -> Column:
    """True where a cell is missing or meets its rule. Text outside a code or boolean rule never does."""
    if rule.exempt:
        return F.lit(True)
    return null_like(df, rule.column) | _meets(df, rule)


def _meets(df: DataFrame, rule: Rule) -> Column:
    cell, dtype = col(rule.column), type_of(df, rule.column)
    number = as_number(df, rule.column)
    if rule.digits is not None:
        if isinstance(dtype, T.StringType):
            return only_digits(cell, rule.digits)
        return _of_width(df, rule.column, rule.digits)
    if rule.boolean:
        if isinstance(dtype, T.StringType):
            return cell.isin(*BOOLEAN_TEXTS)
        return number.isin(0.0, 1.0)
    if not isinstance(dtype, T.NumericType):
        return F.lit(False)
    within = F.lit(True)
    if rule.minimum is not None:
        within = within & (number >= rule.minimum)
    if rule.maximum is not None:
        within = within & (number <= rule.maximum)
    return within


def check_rows(df: DataFrame, rules: Sequence[Rule]) -> Split:
    """Rows of which every cell is valid; the others carry the name of the first column at fault.

    Rules of columns that the table no longer has, say because they were sparse, do not apply.
    """
    checks = {
        rule.column: valid_cell(df, rule)
        for rule in rules
        if not rule.exempt and rule.column in df.columns
    }
    faults = [F.when(~valid, F.lit(f"invalid:{name}")) for name, valid in checks.items()]
    reason = F.coalesce(*faults, F.lit(None).cast("string"))
    return split(df, reason, all_of(checks.values()))


def validate(
    df: DataFrame,
    sample: int = SAMPLE_ROWS,
    order_by: Sequence[str] | None = None,
    exempt: Sequence[str] = EXEMPT_NAMES,
    rules: Sequence[Rule] | None = None,
) -> Split:
    """Learn the rules of a table (unless given) and part its rows by them; see ``learn_rules``."""
    return check_rows(df, rules if rules is not None else learn_rules(df, sample, order_by, exempt))
