"""Repeated keys: the same counts as a plain group by, and few rows moved where there are none."""

import datetime as dt
import random
from collections import Counter

import pytest

from marketframe.operators.unique import crowded_months, repeated_keys
from tests.conftest import rows

SCHEMA = "code string, day date, kind string"


def moved(df):
    """Rows that each shuffle of a finished query wrote."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        inner = node.executedPlan() if name == "AdaptiveSparkPlanExec" else node.plan() if name.endswith("QueryStageExec") else None
        for child in [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_a_plain_count(spark, seed):
    rng = random.Random(seed)
    held = [(rng.choice(["a", "b", None]), rng.choice([None, *(dt.date(2025, 1, 28) + dt.timedelta(days=i) for i in range(40))]), rng.choice("xy")) for _ in range(120)]
    df = spark.createDataFrame(held, SCHEMA)
    for keys in (["code", "day"], ["code", "day", "kind"], ["day"]):
        at = [SCHEMA.replace(",", "").split().index(k) // 2 for k in keys]
        want = {k: n for k, n in Counter(tuple(h[i] for i in at) for h in held).items() if n > 1}
        assert {tuple(r[:-1]): r[-1] for r in rows(repeated_keys(df, keys, "day"))} == want
        assert {tuple(r[:-1]): r[-1] for r in rows(repeated_keys(df, keys))} == want


def test_a_clean_table_moves_a_row_per_code_and_month(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(366)]
    clean = spark.createDataFrame([(c, d, "x") for c in ("a", "b", "c") for d in days], SCHEMA).coalesce(1)
    clean.write.parquet(str(tmp_path / "clean"))
    df = spark.read.parquet(str(tmp_path / "clean"))
    assert crowded_months(df, ["code", "day"], "day").count() == 0
    checked = repeated_keys(df, ["code", "day"], "day")
    assert rows(checked) == []
    assert sum(moved(checked)) <= 3 * 12 < 3 * 366
    one = df.unionByName(df.where("code = 'b' AND day = DATE '2024-05-05'"))
    found = repeated_keys(one, ["code", "day"], "day")
    assert rows(found) == [("b", dt.date(2024, 5, 5), 2)]
    assert rows(crowded_months(one, ["code", "day"], "day")) == [("b", dt.date(2024, 5, 1))]
