"""Whole runs and key functions against plain Python written from the documented meaning."""

import csv
import json
import random
import re
import sqlite3
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidefeed.functions import island_code, norm_key, null_like
from tidefeed.plans import weekly
from tidefeed.schemas import FEEDS

QUICK = settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def code_of(text):
    return (re.sub("[^0-9]", "", text or "")[:2]).rjust(2, "0")


def key_of(text):
    start = re.match(r"\s*([+-]?[0-9]+)", text, re.ASCII)
    number = int(start.group(1)) if start else None
    return number if number is not None and -(2**63) <= number < 2**63 else None


TEXTS = st.lists(
    st.one_of(st.text(alphabet="0123456789+- .ax", max_size=25), st.none()), min_size=1, max_size=40
)


@QUICK
@given(TEXTS)
def test_codes_and_keys_of_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.select("i", island_code(df, "t"), norm_key(df, "t"), null_like(df, "t")).collect()
    for i, code, key, missing in sorted(found):
        assert code == code_of(texts[i])
        assert key == (None if texts[i] is None else key_of(texts[i]))
        assert missing == (not texts[i])


@QUICK
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=40))
def test_codes_of_integers(spark, numbers):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, n bigint")
    for i, code in df.select("i", island_code(df, "n")).collect():
        assert code == code_of(str(numbers[i]))


def make_feeds(seed):
    r = random.Random(seed)
    day = lambda: f"{r.randint(1, 7):02d}-02-2024"
    region = lambda: r.randint(11, 30) * 1000 + r.randint(1, 5)
    oms = [
        (r.randint(0, 50), r.randint(1000, 2000), r.randint(11, 30), 1, r.randint(0, 9), day())
        for _ in range(300)
    ]
    hospital = [
        (r.randint(1, 5), day(), r.randint(0, 1), r.randint(0, 130), r.randint(0, 1), region())
        + tuple(r.randint(0, 1) for _ in range(4))
        for _ in range(400)
    ]
    secretaria = [
        (r.randint(0, 1), r.randint(0, 1), region(), r.randint(0, 5), r.randint(1000, 1100), day())
        for _ in range(400)
    ]
    return {
        "oms": oms + oms[:20],
        "hospital": hospital + hospital[:50],
        "secretaria": secretaria + secretaria[:5],
    }


def expected(feeds):
    def totals(records, key, value):
        sums = defaultdict(float)
        for record in records:
            sums[str(key(record))] += record[value]
        return dict(sums)

    valid = [h for h in set(feeds["hospital"]) if h[3] <= 120]
    a = totals(valid, lambda h: h[5] // 1000, 2)
    b = totals(feeds["oms"], lambda o: o[2], 0)
    c = totals(feeds["secretaria"], lambda s: s[2] // 1000, 1)
    oms = totals(set(feeds["oms"]), lambda o: o[2], 0)
    mean = sum(oms.values()) / len(oms)
    return {
        "hospital": totals(valid, lambda h: h[0], 2).items(),
        "oms": {(k, v, "Vermelho" if v > mean else "Verde") for k, v in oms.items()},
        "secretaria": totals(set(feeds["secretaria"]), lambda s: s[2] // 1000, 1).items(),
        "merge_AB": {(k, v, b.get(k, 0.0)) for k, v in a.items()},
        "merge_AC": {(k, v, c.get(k, 0.0)) for k, v in a.items()},
        "merge_BC": {(k, v, c.get(k, 0.0)) for k, v in b.items()},
        "merge_ABC": {(k, v, b.get(k, 0.0), c.get(k, 0.0)) for k, v in a.items()},
    }


def check(outputs, feeds):
    for name, rows in expected(feeds).items():
        assert Counter(map(tuple, outputs[name].collect())) == Counter(rows), name


@pytest.mark.parametrize("seed", [1, 2])
def test_weekly_run(spark, seed):
    feeds = make_feeds(seed)
    tables = {f: spark.createDataFrame(rows, FEEDS[f]) for f, rows in feeds.items()}
    check(weekly.run(**tables), feeds)


def test_weekly_run_over_files_of_each_format(spark, tmp_path):
    """Tab-separated, CSV in two files, and a database: with broken rows beside the good ones."""
    feeds = make_feeds(3)
    with open(tmp_path / "oms_mock.txt", "w") as f:
        f.write("\t".join(FEEDS["oms"].names) + "\n")
        f.writelines("\t".join(map(str, r)) + "\n" for r in feeds["oms"])
        f.write("1\t2\n\nx\t1\t11\t1\t1\tday\n\t1\t11\t1\t1\tday\n")
    for part in range(2):
        with open(tmp_path / f"hospital_mock_{part}.csv", "w", newline="") as f:
            writer = csv.writer(f)
            writer.writerow(FEEDS["hospital"].names)
            writer.writerows(feeds["hospital"][part::2])
    con = sqlite3.connect(tmp_path / "secretaria_data.db")
    con.execute(f"create table pacientes ({', '.join(FEEDS['secretaria'].names)})")
    con.executemany("insert into pacientes values (?, ?, ?, ?, ?, ?)", feeds["secretaria"])
    con.execute("insert into pacientes values ('x', 1, 11001, 1, 1, '')")
    con.commit()
    con.close()
    (tmp_path / "outro.csv").write_text("a\n1\n")
    paths = sorted(str(p) for p in tmp_path.iterdir())
    with pytest.warns(UserWarning, match="outro"):
        outputs = weekly.run_files(spark, paths)
    check(outputs, feeds)


def test_weekly_run_over_json_files(spark, tmp_path):
    feeds = make_feeds(4)
    for feed, rows in feeds.items():
        objects = [dict(zip(FEEDS[feed].names, row)) for row in rows]
        (tmp_path / f"temp_{feed}.json").write_text(json.dumps(objects, indent=2))
    paths = [f"{tmp_path}/temp_{feed}.json" for feed in feeds]
    check(weekly.run_files(spark, paths), feeds)
    with pytest.raises(ValueError, match="no file of oms"):
        weekly.feeds_of(spark, [p for p in paths if "oms" not in p])
