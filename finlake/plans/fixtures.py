"""Filing, price and news tables derived from the driver's TPC-H-style tables.

The original project reads SEC filing extracts, daily price bars and news
headlines.  None of those ship with it, so the test tables are derived from
``lineitem``/``supplier``/``documents``/``labels`` by a fixed rule (see
FIXTURES.md §B).  Every table here is a lazy DataFrame whose size grows with
the driver tables; the same rule is written independently in DuckDB SQL in
``tools/oracle_sql.py`` for the correctness gate.  By default each table is
written once to the shared checkpoint folder and read from there (see
:class:`Fixtures`).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions import tags
from finlake.session import checkpoint_dir, file_listing
from finlake.sinks.bucketed import Layout, open_bucketed, write_bucketed
from finlake.sources.prices import long_to_wide_maps

DEC = "decimal(18,2)"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Bump when the fixture rule changes so stored copies are rebuilt.
FIXTURE_VERSION = "6"

# Fixed values of the fixture rule.
SEGMENT_NAME = "ProductSegment"
NEWS_FIRST_DAY = "1995-01-02"
NEWS_DAYS = 30

#: filings and facts lie in buckets of the filing key, facts by tag inside
SUB_LAYOUT = Layout("adsh", 16, ("adsh",))
NUM_LAYOUT = Layout("adsh", 16, ("tag", "adsh"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _csum(cond: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(value))), F.lit(0).cast(DEC))


def quarter_measures(lineitem: DataFrame) -> DataFrame:
    """Per (cik, fy, q): the amounts each filing fact is built from (exact decimals)."""
    li = lineitem.select(
        F.col("l_suppkey").alias("cik"),
        F.year("l_shipdate").alias("fy"),
        F.quarter("l_shipdate").alias("q"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").cast(DEC).alias("price"),
        F.col("l_quantity").cast(DEC).alias("qty"),
        F.col("l_discount").cast(DEC).alias("disc"),
    )
    flag, status = F.col("flag"), F.col("status")
    # a filing has few lines, so sums before the shuffle would only widen its rows
    return li.repartition("cik", "fy", "q").groupBy("cik", "fy", "q").agg(
        F.sum("price").alias("rev"),
        _csum(flag == "R", "price").alias("cogs"),
        _csum((flag == "A") & (status == "O"), "price").alias("rd"),
        _csum((flag == "A") & (status == "F"), "price").alias("sga"),
        (_csum(flag == "N", "price") - _csum(flag == "A", "price")).alias("ni"),
        _csum(status == "O", "price").alias("liab"),
        F.sum("qty").alias("shares"),
        F.sum("disc").alias("dv"),
    )


def _period(fy: Column, q: Column) -> Column:
    return F.last_day(F.make_date(fy, q * 3, F.lit(1)))


def _adsh(cik: Column, fy: Column, q: Column) -> Column:
    return F.concat_ws("-", cik.cast("string"), fy.cast("string"), q.cast("string"))


def fs_sub(measures: DataFrame) -> DataFrame:
    cik, fy, q = F.col("cik"), F.col("fy"), F.col("q")
    return measures.select(
        F.concat(fy.cast("string"), F.lit("q"), q.cast("string")).alias("folder"),
        _adsh(cik, fy, q).alias("adsh"),
        cik.cast("bigint").alias("cik"),
        F.when(q == 4, "10-K").otherwise("10-Q").alias("form"),
        _period(fy, q).alias("period"),
        fy.cast("int").alias("fy"),
        F.when(q == 4, "FY").otherwise(F.concat(F.lit("Q"), q.cast("string"))).alias("fp"),
    )


def _fact(tag, qtrs, value: Column, segments=None) -> Column:
    return F.struct(
        (tag if isinstance(tag, Column) else F.lit(tag)).alias("tag"),
        (qtrs if isinstance(qtrs, Column) else F.lit(qtrs)).cast("int").alias("qtrs"),
        value.cast("double").alias("value"),
        F.lit(segments).cast("string").alias("segments"),
    )


def _duration_facts(rev_tag: Column, qtrs: int) -> list[Column]:
    d = lambda c: F.col(c).cast("double")
    return [
        _fact(rev_tag, qtrs, F.col("rev")),
        _fact("CostOfRevenue", qtrs, F.col("cogs")),
        _fact("ResearchAndDevelopmentExpense", qtrs, F.col("rd")),
        _fact("SellingGeneralAndAdministrativeExpense", qtrs, F.col("sga")),
        _fact("NetIncomeLoss", qtrs, F.col("ni")),
        _fact("CommonStockDividendsPerShareDeclared", qtrs, F.col("dv")),
        _fact("EarningsPerShareBasic", qtrs, d("ni") / d("shares")),
    ]


def fs_num_raw(measures: DataFrame) -> DataFrame:
    """Long (EAV) facts per filing, including rows the ingest must reject."""
    cik, fy, q = F.col("cik"), F.col("fy"), F.col("q")
    rev_tag = F.element_at(F.array(*[F.lit(t) for t in tags.REVENUE]), (cik % 3 + 1).cast("int"))
    base = measures.withColumn("adsh", _adsh(cik, fy, q)).withColumn("period", _period(fy, q))

    ytd = base.selectExpr(
        "*",
        "sum(rev - cogs) OVER (PARTITION BY cik, fy ORDER BY q) AS ytd_op",
        "sum(rd) OVER (PARTITION BY cik, fy ORDER BY q) AS ytd_inv",
    )
    quarter_facts = ytd.select(
        "adsh",
        F.col("period").alias("ddate"),
        F.inline(F.array(
            *_duration_facts(rev_tag, 1),
            _fact(tags.OPERATING_CASH_FLOW[0], q, F.col("ytd_op")),
            _fact(tags.INVESTING_CASH_FLOW[0], q, F.col("ytd_inv")),
            _fact(tags.ASSETS, 0, F.col("rev") * 3),
            _fact(tags.LIABILITIES, 0, F.col("liab") * 2),
            _fact(tags.ASSETS_CURRENT, 0, F.col("rev")),
            _fact(tags.LIABILITIES_CURRENT, 0, F.col("liab")),
            _fact(tags.SHARES_OUTSTANDING, 0, F.col("shares")),
            _fact(rev_tag, 1, F.col("rev").cast("double") / 2, SEGMENT_NAME),
        )),
    )

    year = measures.groupBy("cik", "fy").agg(
        *[F.sum(c).alias(c) for c in ("rev", "cogs", "rd", "sga", "ni", "dv", "shares")]
    ).withColumn("q", F.lit(4))
    year_facts = year.select(
        _adsh(cik, fy, q).alias("adsh"),
        _period(fy, q).alias("ddate"),
        F.inline(F.array(*_duration_facts(rev_tag, 4))),
    ).join(base.select("adsh"), "adsh", "left_semi")  # only years that have a Q4 filing

    prior = measures.select(
        "cik", (F.col("fy") + 1).alias("fy"), "q", F.col("rev").alias("prior_rev")
    )
    prior_facts = base.join(prior, ["cik", "fy", "q"]).select(
        "adsh",
        _period(fy - 1, q).alias("ddate"),
        F.inline(F.array(_fact(rev_tag, 1, F.col("prior_rev")))),
    )
    cols = ["adsh", "tag", "ddate", "qtrs", "uom", "segments", "value"]
    return (
        quarter_facts.unionByName(year_facts).unionByName(prior_facts)
        .withColumn("uom", F.lit("USD"))
        .select(*cols)
    )


def stock(lineitem: DataFrame) -> DataFrame:
    """Daily bars per supplier ticker plus an index ticker over all suppliers."""
    li = lineitem.select(
        F.col("l_suppkey"),
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("qty"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
        .alias("ord"),
    )
    # a bar has few lines, so sums before the shuffle would only widen its rows; the order holds the price
    bars = li.select("l_suppkey", "Date", "ord").repartition("l_suppkey", "Date").groupBy("l_suppkey", "Date").agg(
        F.max("ord").getField("l_extendedprice").alias("Close"),
        F.max("ord.l_extendedprice").alias("High"),
        F.min("ord.l_extendedprice").alias("Low"),
        F.min("ord").getField("l_extendedprice").alias("Open"),
        F.sum("ord.l_quantity").cast("bigint").alias("Volume"),
    ).select(
        "Date",
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("Ticker"),
        "Close", "High", "Low", "Open", "Volume",
    )
    index = li.groupBy("Date").agg(
        F.max("price").alias("Close"),
        F.max("price").alias("High"),
        F.min("price").alias("Low"),
        F.min("price").alias("Open"),
        F.sum("qty").cast("bigint").alias("Volume"),
    ).select("Date", F.lit(tags.INDEX_TICKER).alias("Ticker"),
             "Close", "High", "Low", "Open", "Volume")
    return bars.unionByName(index)


def ticker_cik_mapping(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("Symbol"),
        F.col("s_suppkey").cast("bigint").alias("CIK"),
    )


def news(documents: DataFrame, supplier: DataFrame) -> DataFrame:
    """One headline per document: (doc_id, date, symbol, title, lang)."""
    n_sup = supplier.agg(F.count(F.lit(1))).scalar()
    return documents.select(
        "doc_id",
        F.date_add(F.lit(NEWS_FIRST_DAY).cast("date"), (F.col("doc_id") % NEWS_DAYS).cast("int"))
        .alias("date"),
        F.concat(F.lit("S"), (F.col("doc_id") % n_sup + 1).cast("string")).alias("symbol"),
        F.col("text").alias("title"),
        "lang",
    )


def news_with_sentiment(news_df: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled stand-in for model output: toxic -> negative, quality -> positive."""
    lab = labels.select("doc_id", "quality", "toxic")
    return news_df.join(lab, "doc_id", "left").select(
        "doc_id", "date", "symbol", "title",
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral").alias("sentiment"),
    )


def news_source_a(news_df: DataFrame) -> DataFrame:
    """Raw first news source: text columns, timestamp text in UTC."""
    s = lambda c: F.col(c).cast("string")
    return news_df.filter(F.col("lang") == "en").select(
        s("doc_id").alias("Unnamed: 0"),
        F.concat(s("date"), F.lit(" 12:00:00 UTC")).alias("Date"),
        F.col("title").alias("Article_title"),
        F.col("symbol").alias("Stock_symbol"),
        *[F.lit(None).cast("string").alias(c) for c in (
            "Url", "Publisher", "Author", "Article", "Lsa_summary", "Luhn_summary",
            "Textrank_summary", "Lexrank_summary")],
    )


def news_source_b(news_df: DataFrame) -> DataFrame:
    """Raw second news source: (blank), title, date with offset, stock."""
    return news_df.filter(F.col("lang") != "en").select(
        F.col("doc_id").cast("string").alias(""),
        "title",
        F.concat(F.col("date").cast("string"), F.lit(" 09:30:00-04:00")).alias("date"),
        F.col("symbol").alias("stock"),
    )


def _store_root(spark: SparkSession) -> str | None:
    """Shared folder for derived tables: the cluster's ``spark.checkpoint.dir`` (or None)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect session
            root = None
    return root.rstrip("/") if root else None


#: the driver tables that the derived tables read
SOURCES = ("lineitem", "supplier", "documents", "labels")


def _input_key(spark: SparkSession, sf_dir: str) -> str:
    """Identify the input tables (path and each file's size and time) so a stored copy is never stale."""
    h = hashlib.sha1(f"{FIXTURE_VERSION}|{sf_dir.rstrip('/')}".encode())
    for t in SOURCES:
        h.update(f"|{t}:{file_listing(spark, f'{sf_dir}/{t}.parquet')}".encode())
    return h.hexdigest()[:16]


@dataclass
class Fixtures:
    """Fixture tables for one scale-factor folder.

    With ``materialize`` (the default) each derived table is written once as
    Parquet under ``<spark.checkpoint.dir>/finlake-fixtures/<input key>/`` and
    read back from there -- the same shape as production, where the ingest
    jobs load ``fs_sub``/``fs_num``/``stock`` once and the dashboard queries
    read the stored tables.  A table without its ``_SUCCESS`` marker is a failed
    or partial write and is rebuilt.
    """

    spark: SparkSession
    sf_dir: str
    materialize: bool = True
    _cache: dict = field(default_factory=dict)

    @cached_property
    def _key(self) -> str:
        return _input_key(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def _path(self, key: str) -> str:
        return f"{_store_root(self.spark)}/finlake-fixtures/{self._key}/{key}"

    def _memo(self, key, build, layout: Layout | None = None):
        if key not in self._cache:
            if not self.materialize or _store_root(self.spark) is None:
                # no shared folder configured: derive lazily, never a local temp dir
                self._cache[key] = build()
            else:
                self._cache[key] = self._stored(self._path(key), build, layout)
        return self._cache[key]

    def _complete(self, path: str) -> bool:
        """A finished write ends with its ``_SUCCESS`` marker."""
        return any(name == "_SUCCESS" for name, *_ in file_listing(self.spark, path))

    def _stored(self, path: str, build, layout: Layout | None = None) -> DataFrame:
        if not self._complete(path):
            # nothing there, or a half-written table: it is replaced
            if layout:
                write_bucketed(build(), path, layout)
            else:
                build().write.mode("overwrite").parquet(path)
        return open_bucketed(self.spark, path, layout) if layout else self.spark.read.parquet(path)

    def build_all(self) -> None:
        for name in ("fs_sub", "fs_num_raw", "fs_num", "stock", "stock_wide", "mapping", "news",
                     "news_with_sentiment", "staged", "warehouse"):
            getattr(self, name)

    @property
    def measures(self) -> DataFrame:
        """Stored, since filings and facts read it seven times."""
        return self._memo("measures", lambda: quarter_measures(self.table("lineitem")))

    @property
    def fs_sub(self) -> DataFrame:
        return self._memo("fs_sub", lambda: fs_sub(self.measures), SUB_LAYOUT)

    @property
    def fs_num_raw(self) -> DataFrame:
        return self._memo("fs_num_raw", lambda: fs_num_raw(self.measures))

    @property
    def fs_num(self) -> DataFrame:
        from finlake.plans.ingest import keep_period_facts

        return self._memo("fs_num", lambda: keep_period_facts(self.fs_num_raw, self.fs_sub), NUM_LAYOUT)

    @property
    def stock(self) -> DataFrame:
        return self._memo("stock", lambda: stock(self.table("lineitem")))

    @property
    def stock_wide(self) -> DataFrame:
        """The bars as a download has them: one row per date, a ticker map per field."""
        return self._memo("stock_wide", lambda: long_to_wide_maps(self.stock))

    @property
    def staged(self) -> str:
        """Folder of the filings as tab-separated text, in two column layouts (even and odd years)."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/finlake-fixtures/{self._key}/raw"
        if not all(self._complete(f"{path}/{name}") for name in ("sub.txt", "num.txt")):
            sub = self.fs_sub
            num = self.fs_num_raw.join(sub.select("adsh", "folder", "fy"), "adsh")
            day = lambda c: F.date_format(c, "yyyyMMdd").alias(c)
            sub = sub.select("folder", "adsh", "cik", "form", day("period"), "fy", "fp")
            num = num.select("folder", "adsh", "tag", day("ddate"), "qtrs", "uom", "segments", "value", "fy")
            other = {"sub.txt": ["fp", "fy", F.lit("x").alias("zipba"), "cik", "adsh", "period", "form", "folder"],
                     "num.txt": ["value", F.lit("us-gaap").alias("version"), "segments", "ddate", "uom", "qtrs", "tag",
                                 "adsh", "folder"]}
            for name, df in (("sub.txt", sub), ("num.txt", num)):
                keep = [c for c in df.columns if name == "sub.txt" or c != "fy"]
                for mode, odd, cols in (("overwrite", 0, keep), ("append", 1, other[name])):
                    (df.filter(F.col("fy") % 2 == odd).select(*cols).write.mode(mode).partitionBy("folder")
                       .option("header", True).option("sep", "\t").option("quote", "").csv(f"{path}/{name}"))
        return path

    @property
    def warehouse(self) -> str:
        """Root of the filings loaded from the staged text, in two loads and a reload of one quarter."""
        from finlake.plans.ingest import load_warehouse
        from finlake.sinks.warehouse import latest

        path = f"{checkpoint_dir(self.spark).rstrip('/')}/finlake-fixtures/{self._key}/warehouse"
        folders = sorted(r.folder for r in self.fs_sub.select("folder").distinct().collect())
        if set(latest(self.spark, path).recorded) != set(folders):
            where = {"companies": self.mapping.select("CIK"), "pattern": "{name}/folder={folder}", "buckets": 4}
            load_warehouse(self.spark, self.staged, path, folders[::2], **where)
            load_warehouse(self.spark, self.staged, path, folders, **where)
            load_warehouse(self.spark, self.staged, path, folders[:1], replace=True, **where)
        return path

    @property
    def mapping(self) -> DataFrame:
        return self._memo("mapping", lambda: ticker_cik_mapping(self.table("supplier")))

    @property
    def news(self) -> DataFrame:
        return self._memo("news", lambda: news(self.table("documents"), self.table("supplier")))

    @property
    def news_with_sentiment(self) -> DataFrame:
        return self._memo(
            "news_ws", lambda: news_with_sentiment(self.news, self.table("labels")))

    def register_views(self) -> None:
        """Expose the fixture tables to ``spark.sql`` under their original names."""
        self.fs_sub.createOrReplaceTempView("fs_sub")
        self.fs_num.createOrReplaceTempView("fs_num")
        self.stock.createOrReplaceTempView("stock")
        self.mapping.createOrReplaceTempView("ticker_cik_mapping")
