"""Questions asked of the published warehouse by name equal SQL over its views."""

import datetime as dt

from conftest import SF_SMALL
from wattlake.plans import reports, sql_views, warehouse_job
from wattlake.sources.adapters import x_contracts, x_prices_clean, x_products


def test_sql_questions_match_reports(spark, tmp_path):
    feeds = {"products": x_products(spark, SF_SMALL), "prices": x_prices_clean(spark, SF_SMALL),
             "contracts": x_contracts(spark, SF_SMALL)}
    warehouse_job.run(spark, feeds, str(tmp_path), "v1", dt.date(2001, 8, 1),
                      dt.datetime(2026, 1, 1), newest_extract=dt.date(2001, 8, 1),
                      contract_tiebreak=["seq"])
    tables = sql_views.read_published(spark, str(tmp_path), "v1")
    assert set(tables) == set(sql_views.TABLES)
    sql_views.register_views(tables)
    mart, hist = tables["contract_price_enriched"], tables["contracts"]

    def same(a, b):
        return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

    def sql(text):
        return spark.sql(text)

    totals = "sum(m.revenue) sum_revenue, sum(m.consumption) sum_consumption from contract_price_enriched m"
    assert same(sql_views.ask(spark, "revenue_by_created_product"),
                sql(f"select m.createdat, m.productid, {totals} group by all"))
    asked = sql_views.ask(spark, "revenue_by_created", start="DATE '1995-03-01'", end="DATE '1995-06-01'")
    assert same(asked, sql(f"select m.createdat, {totals} where m.createdat >= '1995-03-01' "
                           "and m.createdat <= '1995-06-01' group by all"))
    assert same(asked, reports.revenue_by_created(mart, "03.01.1995", "06.01.1995"))
    assert same(sql_views.ask(spark, "count_distinct_in_delivery", on="DATE '1998-01-01'"),
                sql("with c as (select distinct contract_id from contracts where startdate <= '1998-01-01' and "
                    "(enddate is null or enddate >= '1998-01-01') and status = 'indelivery') select count(*) from c"))
    assert same(sql_views.ask(spark, "new_contracts"),
                sql("select * from contracts where extract(month from createdat) = "
                    "extract(month from add_months(snapshot_date, -1))"))
    assert hist.count() > 0
