"""Delimited text sources: CSV exports (incl. UTF-16) and zipped quarterly archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_news_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType,
                  encoding: str | None = None) -> DataFrame:
    """CSV with a header and a declared schema.

    Quotes are escaped by doubling (``"A ""quoted"" title"``) and quoted
    fields may span lines.  Multi-line files cannot be split, so large
    exports should be staged to Parquet once and read from there.
    """
    r = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
         .option("multiLine", True).schema(schema))
    if encoding:
        r = r.option("encoding", encoding)
    return r.csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with inferred types (an extra pass over the data; prefer a schema)."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("quote", '"').option("escape", '"').csv(path))


LINES_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
])


def read_zip_members(spark: SparkSession, path: str, member_glob: str | None = None,
                     encoding: str = "utf-8", chunk_lines: int = 50_000) -> DataFrame:
    """Lines of the members of zip archives: (path, member, line_no, line).

    One archive is one task (a zip cannot be split); members are streamed and
    emitted in chunks so a task never holds a whole member as Python rows.
    ``member_glob`` keeps members whose base name matches (e.g. 'num.txt').
    """
    import fnmatch

    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def explode_archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for info in zf.infolist():
                        base = info.filename.rsplit("/", 1)[-1]
                        if info.is_dir() or (member_glob and not fnmatch.fnmatch(base, member_glob)):
                            continue
                        with zf.open(info) as fh:
                            text = io.TextIOWrapper(fh, encoding=encoding, newline="")
                            buf, start = [], 0
                            for i, raw in enumerate(text):
                                buf.append(raw.rstrip("\r\n"))
                                if len(buf) >= chunk_lines:
                                    yield _lines_frame(p, info.filename, start, buf)
                                    start, buf = i + 1, []
                            if buf:
                                yield _lines_frame(p, info.filename, start, buf)

    return files.mapInPandas(explode_archives, LINES_SCHEMA)


def _lines_frame(path: str, member: str, start: int, lines: list[str]) -> pd.DataFrame:
    n = len(lines)
    return pd.DataFrame({"path": [path] * n, "member": [member] * n,
                         "line_no": range(start, start + n), "line": lines})


def tab_fields(lines: DataFrame, header: list[str]) -> DataFrame:
    """Split tab-separated lines into named string columns (header line dropped)."""
    parts = F.split(F.col("line"), "\t", -1)
    body = lines.filter(F.col("line_no") > 0)
    return body.select("path", "member", *[
        F.when(F.size(parts) > i, F.nullif(parts[i], F.lit(""))).alias(name)
        for i, name in enumerate(header)])
