import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from hanok.operators.ranking import ranked_values

R = random.Random(5)
CASES = {
    "DOUBLE": [0.0, -1.5, float("inf"), float("-inf"), float("nan"), 1e300, -1e300, 1e-300, *(R.gauss(0, 10 ** R.randrange(9)) for _ in range(300))],
    "BIGINT": [0, -1, 1, 1 << 62, -(1 << 62), *(R.randrange(-(10**6), 10**6) for _ in range(300)), *range((1 << 60), (1 << 60) + 50)],
    "STRING": ["", "a", "ab", "abc", "abcd", "abcé", "é", "가나", "\U0001f600", "abc\x01", *("".join(R.choice("abé가z ") for _ in range(R.randrange(7))) for _ in range(300))],
    "DATE": [date(1969, 12, 31), date(1970, 1, 1), *(date(2000, 1, 1) + timedelta(R.randrange(-20_000, 20_000)) for _ in range(200))],
    "TIMESTAMP": [datetime(1970, 1, 1), *(datetime(2000, 1, 1) + timedelta(seconds=R.random() * 10**9) for _ in range(200))],
    "DECIMAL(20,2)": [Decimal(R.randrange(-(10**9), 10**9)) / 100 for _ in range(200)],
    "BOOLEAN": [True, False],
}


@pytest.mark.parametrize("kind", CASES)
def test_ranks_are_those_of_a_sort(spark, kind):
    values = [*CASES[kind], *CASES[kind][:5], None]
    got = {str(r.v): r.rank for r in ranked_values(spark.createDataFrame([(v,) for v in values], f"v {kind}"), "v", "rank").collect()}
    plain = {v for v in values if v is not None and v == v}
    order = sorted(plain, key=lambda v: v.encode() if isinstance(v, str) else v)
    want = {str(v): i for i, v in enumerate(order)} | ({"nan": len(order)} if kind == "DOUBLE" else {})
    assert {k.replace("-0.0", "0.0"): v for k, v in got.items()} == (want if kind != "DECIMAL(20,2)" else {f"{v:.2f}": i for i, v in enumerate(order)})


def test_one_task_orders_buckets_only(spark):
    df = spark.range(200_000).selectExpr("id * 1.5D AS v")
    ranks = ranked_values(df, "v", "rank")
    ranks.collect()
    plan = ranks._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) == 1 and ranks.where("rank <> v / 1.5D").isEmpty()
