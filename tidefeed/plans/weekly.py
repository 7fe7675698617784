"""The weekly run over the three feeds, and the five analyses of its outputs."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.functions import as_number
from tidefeed.operators import (
    alert_rows,
    clean_observed,
    group_sum,
    group_sum_island,
    linreg,
    mean_alert,
    merge_three,
    pearson,
    stats,
    stats_by,
    validate,
)
from tidefeed.operators.aggregate import ALERT_COLUMN
from tidefeed.operators.clean import SPARSE_THRESHOLD
from tidefeed.operators.routing import ORIGINS
from tidefeed.operators.validate import Rule, rule_evidence, rules_from
from tidefeed.schemas import FEEDS
from tidefeed.sinks import write_outputs
from tidefeed.sources import load
from tidefeed.storage import materialize, run_folder, run_together

# The key and the measure of each feed, and the common code of the merge.
CODE = "cep"
HOSPITAL_KEY, HOSPITAL_MEASURE = "id_hospital", "internado"
OMS_MEASURE = "num_obitos"
SECRETARIA_MEASURE = "vacinado"

#: How often a distinct row was there.
COPIES = "__copies"


def treat(
    feed: DataFrame,
    keep: Sequence[str],
    *,
    threshold: float = SPARSE_THRESHOLD,
    dedupe: bool = True,
    rules: Sequence[Rule] | None = None,
) -> DataFrame:
    """Clean a feed, then keep its valid rows. The columns in ``keep`` are never dropped as sparse.

    Rules that are not given are learnt from all cleaned rows, while these are written.
    """
    return _treated(feed, keep, threshold=threshold, dedupe=dedupe, rules=rules)[0].drop(COPIES)


def _treated(
    feed: DataFrame,
    keep: Sequence[str],
    *,
    threshold: float = SPARSE_THRESHOLD,
    dedupe: bool = True,
    rules: Sequence[Rule] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and the table as received: its distinct rows with the number of their copies."""
    evidence = [] if rules is not None else rule_evidence(feed)
    cleaned, seen = clean_observed(
        feed, threshold, evidence, dedupe=dedupe, keep=keep, copies=COPIES
    )
    if rules is None:
        rules = rules_from(feed, seen)
    return validate(cleaned, rules=rules).accepted, cleaned if dedupe else feed


def _as_received(table: DataFrame, measure: str) -> DataFrame:
    """The table with its measure times the number of copies."""
    if COPIES not in table.columns:
        return table
    return table.withColumn(measure, as_number(table, measure) * F.col(COPIES))


def run(
    oms: DataFrame,
    secretaria: DataFrame,
    hospital: DataFrame,
    base: str | None = None,
    *,
    per_feed: Mapping[str, Mapping] | None = None,
    **treatment,
) -> dict[str, DataFrame]:
    """Treat, total and merge the three feeds; write the outputs below ``base`` if given.

    ``treatment`` goes to ``treat`` for all feeds and ``per_feed`` for one, say
    ``{"hospital": {"rules": rules}}`` for rules that an earlier run has learnt.

    The outputs are the three feeds' totals and the merges. The feeds are treated side by side, each
    scanned once: totals of a feed as received come from its distinct rows and their numbers. All totals
    are stored, so that the merges and the analyses start from a few rows per island instead of from the
    feeds. With ``base`` the intermediate tables are removed once the outputs are written, and the
    outputs are those read back from there.
    """
    spark = hospital.sparkSession
    if base is None:
        return _run(oms, secretaria, hospital, per_feed, treatment)
    with run_folder(spark, "weekly"):
        write_outputs(_run(oms, secretaria, hospital, per_feed, treatment), base)
    return load_outputs(spark, base)


def _run(
    oms: DataFrame,
    secretaria: DataFrame,
    hospital: DataFrame,
    per_feed: Mapping[str, Mapping] | None,
    treatment: Mapping,
) -> dict[str, DataFrame]:
    def treated(name: str, feed: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
        return _treated(feed, keep, **{**treatment, **(per_feed or {}).get(name, {})})

    def stored(label: str, table: DataFrame) -> DataFrame:
        return materialize(table, label)[0]

    def hospital_totals() -> tuple[DataFrame, DataFrame]:
        rows, _ = treated("hospital", hospital, HOSPITAL_KEY, CODE, HOSPITAL_MEASURE)
        return (
            stored("hospital", group_sum(rows, HOSPITAL_KEY, HOSPITAL_MEASURE)),
            stored("hospital-island", group_sum_island(rows, CODE, HOSPITAL_MEASURE)),
        )

    # The merge takes the totals of the feeds as received for these two.
    def oms_totals() -> tuple[DataFrame, DataFrame]:
        rows, received = treated("oms", oms, CODE, OMS_MEASURE)
        received = _as_received(received, OMS_MEASURE)
        return (
            stored("oms", group_sum(rows, CODE, OMS_MEASURE)),
            stored("oms-received", group_sum(received, CODE, OMS_MEASURE)),
        )

    def secretaria_totals() -> tuple[DataFrame, DataFrame]:
        rows, received = treated("secretaria", secretaria, CODE, SECRETARIA_MEASURE)
        received = _as_received(received, SECRETARIA_MEASURE)
        return (
            stored("secretaria", group_sum_island(rows, CODE, SECRETARIA_MEASURE)),
            stored("secretaria-received", group_sum_island(received, CODE, SECRETARIA_MEASURE)),
        )

    (per_hospital, a), (per_code, b), (per_island, c) = run_together(
        hospital.sparkSession, hospital_totals, oms_totals, secretaria_totals
    )
    merged = merge_three(a, b, c, CODE, f"Total_{OMS_MEASURE}", f"Total_{SECRETARIA_MEASURE}")
    return {
        "hospital": per_hospital,
        "oms": mean_alert(per_code, f"Total_{OMS_MEASURE}"),
        "secretaria": per_island,
        **{f"merge_{name}": table for name, table in merged.items()},
    }


#: The layout of each output.
OUTPUTS = {
    "hospital": "id_hospital string, Total_internado double",
    "oms": "cep string, Total_num_obitos double, Alertas string",
    "secretaria": "cep string, Total_vacinado double",
    "merge_AB": "cep string, Total_internado double, Total_num_obitos_B double",
    "merge_ABC": "cep string, Total_internado double, Total_num_obitos_B double, "
    "Total_vacinado_C double",
    "merge_AC": "cep string, Total_internado double, Total_vacinado_C double",
    "merge_BC": "cep string, Total_num_obitos double, Total_vacinado_C double",
}


def load_outputs(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The outputs that an earlier run has written below ``base``."""
    folder = base.rstrip("/")
    return {
        name: spark.read.schema(layout).option("header", True).csv(f"{folder}/{name}")
        for name, layout in OUTPUTS.items()
    }


def feeds_of(spark: SparkSession, paths: Sequence[str]) -> dict[str, DataFrame]:
    """The feeds in files of any supported format, each path routed by the name of its file.

    Several files of one feed are pooled. A path of no known feed is left out with a warning, and a
    feed without a path is an error.
    """
    found: dict[str, list[DataFrame]] = {}
    for path in paths:
        name = path.rstrip("/").rpartition("/")[2]
        origin = next((word for word in ORIGINS if word in name), None)
        if origin is None:
            warnings.warn(f"unknown origin: {path}", stacklevel=2)
        else:
            found.setdefault(origin, []).append(load(spark, path, FEEDS[origin]))
    absent = sorted(set(FEEDS) - set(found))
    if absent:
        raise ValueError(f"no file of {', '.join(absent)}")
    return {origin: reduce(DataFrame.unionByName, parts) for origin, parts in found.items()}


def run_files(
    spark: SparkSession, paths: Sequence[str], base: str | None = None, **treatment
) -> dict[str, DataFrame]:
    """``run`` over the feeds in files."""
    feeds = feeds_of(spark, paths)
    return run(feeds["oms"], feeds["secretaria"], feeds["hospital"], base, **treatment)


def report(outputs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five analyses of a run's outputs."""
    internados = f"Total_{HOSPITAL_MEASURE}"
    vacinados = f"Total_{SECRETARIA_MEASURE}_C"
    return {
        "alertas": alert_rows(outputs["oms"], CODE).orderBy(ALERT_COLUMN, CODE),
        "estatisticas": stats(outputs["hospital"], internados),
        "estatisticas_por_hospital": stats_by(outputs["hospital"], HOSPITAL_KEY, internados),
        "correlacao": pearson(outputs["merge_BC"], f"Total_{OMS_MEASURE}", vacinados),
        "regressao": linreg(outputs["merge_AC"], x=vacinados, y=internados),
    }
