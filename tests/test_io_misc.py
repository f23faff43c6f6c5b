"""Small source/sink helpers: inferred CSV, JSON records, object-store settings, price replace."""

import datetime as dt
import json
import os

from finlake.plans.ingest import ingest_prices
from finlake.session import object_store_conf
from finlake.sinks.writers import write_json
from finlake.sources.text import read_csv_inferred

from .conftest import rows


def test_inferred_csv_and_json_records(spark, scratch):
    path = os.path.join(scratch, "nasdaq.csv")
    with open(path, "w") as fh:
        fh.write("Symbol,Name,Volume\nAAA,\"A, Inc.\",3000000000\nBBB,B Co,7\n")
    df = read_csv_inferred(spark, path)
    assert dict(df.dtypes)["Volume"] in ("bigint", "int")
    assert rows(df) == [("AAA", "A, Inc.", 3000000000), ("BBB", "B Co", 7)]
    out = os.path.join(scratch, "json")
    write_json(df.filter("Symbol = 'BBB'"), out)
    parts = [f for f in os.listdir(out) if f.endswith(".json")]
    recs = [json.loads(line) for f in parts for line in open(os.path.join(out, f))]
    assert recs == [{"Symbol": "BBB", "Name": "B Co", "Volume": 7}]


def test_object_store_conf_takes_keys_as_arguments():
    conf = object_store_conf("k", "s", endpoint="http://minio:9000")
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://minio:9000"
    assert "spark.hadoop.fs.s3a.access.key" not in object_store_conf()


def test_price_ingest_replaces_the_table(spark, scratch):
    wide = spark.createDataFrame(
        [(dt.date(2020, 1, 2), 1.0, 2.0, 0.5, 1.5, 10)],
        "Date date, `Close|AAA` double, `High|AAA` double, `Low|AAA` double, "
        "`Open|AAA` double, `Volume|AAA` long")
    path = os.path.join(scratch, "stock")
    ingest_prices(wide, path)
    ingest_prices(wide, path)  # a re-run replaces, never appends
    assert rows(spark.read.parquet(path)) == [(dt.date(2020, 1, 2), "AAA", 1.0, 2.0, 0.5, 1.5, 10)]
