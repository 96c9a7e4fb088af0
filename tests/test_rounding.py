"""Rounding contract: Spark's decimal formulas and the SQL twins' integer formula
both equal exact half-away-from-zero rounding (checked against Python Decimal)."""

import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb

from orderlens.functions import rate_pct, round_ratio
from orderlens.plans.oracle import half_up


def _cases(n=400, seed=7):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        den = rnd.randint(1, 10_000)
        cents = rnd.randint(-5_000_000, 50_000_000)
        out.append((cents, den))
    # exact ties at the rounding digit, both signs
    out += [(1005, 1000), (-125, 100), (5, 2), (-5, 2), (15, 200), (25, 200)]
    return out


def test_money_average_rounding(spark):
    cases = _cases()
    df = spark.createDataFrame([(Decimal(c) / 100, d) for c, d in cases], "s decimal(20,2), n bigint")
    got = [r.x for r in df.select(round_ratio("s", "n").alias("x")).collect()]
    want = [(Decimal(c) / 100 / d).quantize(Decimal("0.01"), ROUND_HALF_UP) for c, d in cases]
    assert got == want
    con = duckdb.connect()
    sql = f"SELECT {half_up('c', 'd')} AS q FROM (VALUES {', '.join(f'({c}, {d})' for c, d in cases)}) t(c, d)"
    duck = [Decimal(int(r[0])) / 100 for r in con.execute(sql).fetchall()]
    # c / d in cents rounded to whole cents == (c/100) / d rounded to 0.01
    assert duck == want


def test_percentage_rounding(spark):
    rnd = random.Random(11)
    cases = [(rnd.randint(0, 500), rnd.randint(1, 500)) for _ in range(400)]
    cases = [(min(p, w), w) for p, w in cases] + [(1, 8), (1, 16), (5, 100), (1, 3)]
    df = spark.createDataFrame(cases, "p bigint, w bigint")
    got = [r.x for r in df.select(rate_pct("p", "w").alias("x")).collect()]
    want = [(Decimal(p) * 100 / Decimal(w)).quantize(Decimal("0.01"), ROUND_HALF_UP) for p, w in cases]
    assert got == want
    con = duckdb.connect()
    sql = (f"SELECT {half_up('p * 10000', 'w')} AS q FROM "
           f"(VALUES {', '.join(f'({p}, {w})' for p, w in cases)}) t(p, w)")
    assert [Decimal(int(r[0])) / 100 for r in con.execute(sql).fetchall()] == want
