"""split_yearly against a brute-force series on random intervals."""

import datetime as dt
import random

from wattlake.operators import intervals


def _plus_year(d: dt.date) -> dt.date:
    try:
        return d.replace(year=d.year + 1)
    except ValueError:  # 29 Feb -> 28 Feb, as interval arithmetic does
        return d.replace(year=d.year + 1, day=28)


def _series(start: dt.date, until: dt.date):
    out, cur = [], start
    while cur <= until:
        out.append((cur, min(until, dt.date(cur.year, 12, 31))))
        cur = _plus_year(cur)
    return out


def test_split_yearly_equals_iterated_series(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        if i % 3 == 0:
            start = dt.date(rnd.choice([1996, 2000, 2004, 2008]), 2, 29)
        else:
            start = dt.date(1995, 1, 1) + dt.timedelta(rnd.randint(0, 5000))
        until = start + dt.timedelta(rnd.randint(-30, 4000))
        rows.append((i, start, until))
    df = spark.createDataFrame(rows, "i int, valid_from date, valid_until date")
    got = {}
    for r in intervals.split_yearly(df).collect():
        got.setdefault(r.i, []).append((r.period_start, r.period_end))
    for i, s, u in rows:
        assert sorted(got.get(i, [])) == _series(s, u), (s, u)
