"""Sums with the same bits however the rows are dealt, and holdings nobody holds."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shockwell import CalculationMatrix, Parameters
from shockwell.functions.aggregates import exact_total
from shockwell.operators import concentration, holdings as hold, positions as pos
from tests.conftest import calc, holdings, positions


def added(frame):
    return {r.k: r.s for r in frame.groupBy("k").agg(F.expr(f"{exact_total('v')} AS s")).collect()}


def test_equal_bits_over_partitions_and_orders(spark):
    draw = random.Random(5)
    data = [(i % 3, draw.choice((1, -1)) * draw.random() * 10.0 ** draw.randint(-9, 15)) for i in range(4000)]
    results = []
    for parts in (1, 7, 64):
        draw.shuffle(data)
        results.append(added(spark.createDataFrame(data, "k int, v double").repartition(parts)))
    assert results[0] == results[1] == results[2]
    for k, got in results[0].items():
        exact = math.fsum(v for own, v in data if own == k)
        assert got == pytest.approx(exact, rel=1e-15)


def test_cancelling_and_missing_numbers(spark):
    rows = [(0, 1e16), (0, 1.0), (0, -1e16), (1, None), (2, 0.1), (2, 0.2), (2, -0.1), (2, None), (3, 2.0 ** -90), (3, -0.0)]
    got = added(spark.createDataFrame(rows, "k int, v double").repartition(5))
    assert got == {0: 1.0, 1: 0.0, 2: 0.2, 3: 2.0 ** -90}


def test_numbers_beyond_the_limbs(spark):
    rows = [(0, 1e30), (0, 1.0), (0, -1e30), (1, math.inf), (1, 1.0), (2, math.nan), (2, 1.0), (3, math.inf), (3, -math.inf), (4, 1e300), (4, -1.0)]
    got = added(spark.createDataFrame(rows, "k int, v double"))
    assert got[0] == 1.0 and got[1] == math.inf and math.isnan(got[2]) and math.isnan(got[3]) and got[4] == 1e300
    assert added(spark.createDataFrame([], "k int, v double")) == {}


def test_fund_facts_and_steps_do_not_depend_on_partitions(spark):
    draw = random.Random(6)
    given = [{"portfolio_id": f"F{i % 4}", "valuation_weight": draw.random() / 50, "mod_dur_of_underlying": draw.random() * 9} for i in range(400)]
    exposures = [{"portfolio_id": f"F{i % 4}", "value": draw.uniform(-1, 1) * 10 ** draw.randint(0, 9), "cqs": str(draw.randint(0, 6))} for i in range(400)]
    held, rows = holdings(spark, *given), calc(spark, *exposures)
    wide = CalculationMatrix({"concentration": frozenset(r[0] for r in rows.select("calculation_type").distinct().collect())})
    facts, steps = [], []
    for parts in (1, 7, 64):
        facts.append(sorted(hold.fund_facts(held.repartition(parts)).collect()))
        flat, _ = concentration.exposures(rows.repartition(parts), Parameters(), wide)
        steps.append(sorted(map(repr, flat.collect())))
    assert facts[0] == facts[1] == facts[2]
    assert steps[0] == steps[1] == steps[2]


def test_holdings_nobody_holds_are_not_exchanged(spark):
    # 1,000 funds of 5 holdings, a tenth of them held
    h = holdings(spark, *({"portfolio_id": f"F{i % 1000}"} for i in range(5000)))
    p = positions(spark, *({"portfolio_id": f"F{10 * i}"} for i in range(100)), {"portfolio_id": None}, {"portfolio_id": "none"})
    flagged = pos.flagged_positions(p, hold.fund_facts(h))
    kept = pos.held_only(h, p.select("portfolio_id"))
    assert 500 <= kept.count() <= 510
    assert kept.columns == h.columns
    joined = pos.look_through(flagged, hold.with_row_type(h), hold.fund_facts(h))
    assert joined.count() == 500
    assert joined.select("portfolio_id").distinct().count() == 100
    assert pos.held_only(h, p.limit(0).select("portfolio_id")).count() == 0
