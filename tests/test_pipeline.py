"""Production path: staged quarter files -> ingest -> dashboard KPIs == KPIs on the fixture tables."""

import os

from pyspark.sql import functions as F

from finlake.plans import ingest, kpi
from finlake.plans.fixtures import Fixtures

from .conftest import SF_SMALL, rows
from .test_ingest import stage


def test_ingested_tables_give_the_same_kpis(spark, scratch):
    fx = Fixtures(spark, SF_SMALL, materialize=False)
    folders = sorted(r.folder for r in fx.fs_sub.select("folder").distinct().collect())
    raw = os.path.join(scratch, "raw")
    os.makedirs(raw)
    stage(spark, fx, raw, folders)
    companies = fx.mapping.select(F.col("CIK"))
    loaded = ingest.ingest_filings(spark, raw, os.path.join(scratch, "tables"), folders,
                                   companies, os.path.join(scratch, "ledger"))
    assert loaded == folders
    sub, num = ingest.read_loaded(spark, os.path.join(scratch, "tables"))
    for query in (kpi.margins, kpi.revenue_growth, kpi.cash_flow):
        assert rows(query(num, sub, fx.mapping)) == rows(query(fx.fs_num, fx.fs_sub, fx.mapping))
    assert rows(kpi.pe_ratio(num, sub, fx.mapping, fx.stock)) == \
        rows(kpi.pe_ratio(fx.fs_num, fx.fs_sub, fx.mapping, fx.stock))


def test_warehouse_views_and_parameterised_sql(spark, scratch):
    from finlake.sources.tables import register_warehouse

    fx = Fixtures(spark, SF_SMALL, materialize=False)
    root = os.path.join(scratch, "wh")
    fx.fs_sub.write.parquet(f"{root}/fs_sub")
    fx.mapping.write.parquet(f"{root}/ticker_cik_mapping")
    assert register_warehouse(spark, root) == ["fs_sub", "ticker_cik_mapping"]
    got = spark.sql(
        "SELECT count(*) FROM fs_sub s JOIN ticker_cik_mapping m ON m.CIK = s.cik "
        "WHERE m.Symbol = :symbol AND s.fp = :fp", args={"symbol": "S3", "fp": "FY"}).first()[0]
    want = kpi.company_filings(fx.fs_sub, fx.mapping, symbols=["S3"]).filter("fp = 'FY'").count()
    assert got == want > 0
