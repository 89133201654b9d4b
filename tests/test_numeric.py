"""Exact proration arithmetic against Python decimals (half away from zero)."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal, getcontext

from wattlake.operators import revenue

getcontext().prec = 60
Q6 = Decimal("0.000001")


def _r6(x: Decimal) -> Decimal:
    return x.quantize(Q6, rounding=ROUND_HALF_UP)


def test_proration_matches_exact_decimals(spark):
    rnd = random.Random(7)
    rows = []
    base = dt.date(2020, 1, 1)
    for cid in range(300):
        n = rnd.randint(1, 4)
        start = base
        cuts = sorted(rnd.sample(range(1, 360), n))
        bounds = [0] + cuts + [cuts[-1] + rnd.randint(1, 40)]
        bp = Decimal(rnd.randint(0, 10**12)) / Decimal(10**10)   # up to 10 decimals
        wp = Decimal(rnd.randint(0, 10**12)) / Decimal(10**10)
        cons = rnd.choice([0, rnd.randint(1, 15000), 2**31 - 1])
        for a, b in zip(bounds, bounds[1:]):
            rows.append((cid, 1, start + dt.timedelta(a), start + dt.timedelta(b), "active", cons,
                         start, start + dt.timedelta(bounds[-1]), start, bp, wp))
    schema = ("contract_id long, productid int, period_start date, period_end date, status string, "
              "consumption int, startdate date, enddate date, createdat date, "
              "baseprice decimal(38,10), workingprice decimal(38,10)")
    out = revenue.prorate(spark.createDataFrame(rows, schema), dt.date(2021, 1, 1)).collect()
    assert len(out) == len(rows)
    totals = {}
    for r in rows:
        totals[(r[0])] = totals.get(r[0], 0) + (r[3] - r[2]).days  # one contract year each
    for r in out:
        d, t = Decimal(r.days_in_period), Decimal(r.total_days_in_year)
        assert t == totals[r.contract_id]
        assert r.period_share == _r6(d / t)
        assert r.base_cost == _r6(r.baseprice * d / t)
        assert r.variable_cost == _r6(r.workingprice * r.consumption * d / Decimal(36500))
        assert r.weighted_consumption == _r6(Decimal(r.consumption) * d / 365)
        if r.consumption:
            assert r.consumption_share == _r6(d / 365)
        else:
            assert r.consumption_share is None
        assert r.revenue == r.base_cost + r.variable_cost
