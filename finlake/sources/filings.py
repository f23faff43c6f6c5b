"""Readers for quarterly financial-statement extracts (tab-separated text).

Each quarter is a folder ``<root>/<yyyy>q<n>/`` holding ``sub.txt`` (one row per
filing) and ``num.txt`` (one row per reported number); either may be a folder of
part files.  Files of one column layout are read by one distributed scan under
that layout's own schema, and the layouts are united by column name; the folder
name comes from the file path.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the filing table that the pipeline keeps (the rest are dropped).
SUB_KEEP = (
    "adsh", "cik", "name", "sic", "countryba", "stprba", "cityba",
    "countryinc", "stprinc", "fye", "form", "period", "fy", "fp",
)
NUM_KEEP = ("adsh", "tag", "ddate", "qtrs", "uom", "segments", "value")

#: every header names the filing key
KEY = "adsh"

#: where a folder's file lies under the root
PATTERN = "{folder}/{name}"

# last "/yyyyqN/" segment of the path (a file or a directory of part files)
FOLDER_RE = r".*/(?:folder=)?([0-9]{4}q[1-4])/"


def _tsv_reader(spark: SparkSession):
    # Text as it is: no quoting (a leading '"' is data), no schema inference pass.
    return (spark.read.option("header", True).option("sep", "\t")
            .option("quote", "").option("escape", "").option("mode", "PERMISSIVE"))


def folder_of_file() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), FOLDER_RE, 1)


def _paths(root: str, folders: list[str], name: str, pattern: str) -> list[str]:
    return [f"{root.rstrip('/')}/{pattern.format(folder=f, name=name)}" for f in folders]


def layouts(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Column names -> the files that have them, by each file's own first line.

    One job over all paths, however many files they hold: of each file only the
    line that names the filing key among its fields is kept.  What comes to the
    driver is a line per file, as its listing does anyway.  A file whose first
    line is no such header can't be read by name and is an error; empty files
    have no rows.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.rtrim(F.col("value"), F.lit("\r")).alias("line"))
    named = F.array_contains(F.split("line", "\t"), KEY)
    first = lines.filter("block = 0").groupBy("file").agg(F.min("at").alias("at"))
    heads = lines.filter((F.col("block") == 0) & named).select("file", "at", "line")
    out: dict[tuple[str, ...], list[str]] = {}
    bad = []
    for r in first.join(heads, ["file", "at"], "left").collect():
        if r.line is None:
            bad.append(unquote(r.file))
        else:
            out.setdefault(tuple(r.line.split("\t")), []).append(unquote(r.file))
    if bad:
        raise ValueError(f"no header with the column {KEY} in the first line of {sorted(bad)[:5]} ({len(bad)} files)")
    return out


def _literal(path: str) -> str:
    """A path in which no character is a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _read(spark: SparkSession, found: dict[tuple[str, ...], list[str]], keep: tuple[str, ...]) -> DataFrame:
    """The kept columns of all layouts by name, as text; a column a layout lacks is NULL."""
    out = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in ("folder", *keep)))
    for names, files in sorted(found.items()):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = _tsv_reader(spark).schema(schema).csv([_literal(f) for f in sorted(files)])
        out = out.unionByName(raw.select(folder_of_file().alias("folder"), *[
            F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in keep]))
    return out


def read_sub(spark: SparkSession, root: str, folders: list[str], pattern: str = PATTERN) -> DataFrame:
    """Filings of the folders, whatever the order and number of each folder's columns."""
    found = layouts(spark, _paths(root, folders, "sub.txt", pattern))
    present = {c for names in found for c in names}
    raw = _read(spark, found, tuple(c for c in SUB_KEEP if c in present or not found))
    typed = {
        "cik": F.col("cik").try_cast("bigint"),
        "period": F.try_to_date(F.col("period"), "yyyyMMdd"),
        "fy": F.col("fy").try_cast("int"),
    }
    return raw.withColumns({c: v for c, v in typed.items() if c in raw.columns})


def read_num(spark: SparkSession, root: str, folders: list[str], pattern: str = PATTERN) -> DataFrame:
    """Facts of the folders; a field that isn't of its type becomes NULL (see :func:`rejects`)."""
    raw = _read(spark, layouts(spark, _paths(root, folders, "num.txt", pattern)), NUM_KEEP)
    return raw.select(
        "folder", "adsh", "tag",
        F.try_to_date(F.col("ddate"), "yyyyMMdd").alias("ddate"),
        F.col("qtrs").try_cast("int").alias("qtrs"),
        "uom", "segments",
        F.col("value").try_cast("double").alias("value"),
    )


def rejects(spark: SparkSession, root: str, folders: list[str], pattern: str = PATTERN) -> DataFrame:
    """Per folder how many facts have a date, quarter count or value that doesn't parse."""
    raw = _read(spark, layouts(spark, _paths(root, folders, "num.txt", pattern)), NUM_KEEP)
    bad = lambda c, parsed: F.count_if(F.col(c).isNotNull() & parsed.isNull()).alias(f"bad_{c}")
    return raw.groupBy("folder").agg(
        F.count(F.lit(1)).alias("facts"),
        bad("ddate", F.try_to_date(F.col("ddate"), "yyyyMMdd")),
        bad("qtrs", F.col("qtrs").try_cast("int")),
        bad("value", F.col("value").try_cast("double")))
