"""Operators 4 and 9 against DuckDB, on driver tables and on awkward rows."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from finlake.llm import line_dedup, mixing, oracle, queries
from tools.check_oracle import _rows, duck

from .data import SMALL, awkward, awkward_rows, empty


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    df = queries.queries()[name](spark, SMALL)
    cur = duck(SMALL).execute(oracle.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows([r.asDict() for r in df.collect()], sorted(cols)) == \
        _rows([dict(zip(cols, r)) for r in cur.fetchall()], sorted(cols))


def _duck_rows(sql, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def _unique(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def test_mixing_awkward_rows_equal_sql(spark):
    rows = _unique(awkward_rows())
    cols, want = _duck_rows(oracle.OP4, rows)
    got = mixing.mix(awkward(spark).dropDuplicates(["doc_id"]).filter("false").select(
        "doc_id", "text", "lang", "source").unionByName(
            spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))).select(*cols)
    assert _rows([r.asDict() for r in got.collect()], sorted(cols)) == \
        _rows([dict(zip(cols, r)) for r in want], sorted(cols))


def test_mixing_keeps_every_row_and_its_bounds(spark):
    got = mixing.mix(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    assert all(0 <= r.copies <= 3 and r.taken == r.copies * r["size"] for r in got)
    totals = {}
    for r in got:
        totals[r.source] = (r.target, r.source_size)
    assert all(t <= 3 * s + 1e-9 for t, s in totals.values())
    assert sum(t for t, _ in totals.values()) == pytest.approx(sum(s for _, s in totals.values()))
    assert mixing.mix(empty(spark)).count() == 0
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(awkward(spark)).collect()))


def test_mixing_emits_whole_rows_once_per_copy(spark):
    """Awkward rows many times over, with repeated ids, texts and whole rows; also the last stage of the pipeline."""
    docs = awkward(spark)
    for k in range(1, 4):
        docs = docs.unionByName(awkward(spark).withColumn("_d", F.lit(k % 3)).withColumn(
            "doc_id", F.when(F.col("doc_id") > 5, F.col("doc_id") + 100 * k).otherwise(F.col("doc_id"))))
    inputs = {}
    for r in docs.collect():
        inputs[tuple(r)] = inputs.get(tuple(r), 0) + 1
    got = mixing.emit(docs).collect()
    of, numbers = {}, {}
    for r in got:
        assert tuple(r.row) in inputs and r["size"] == len(re.findall(mixing.WORD, r.row.text or ""))
        of[r.source, r["rank"]] = r
        numbers.setdefault((r.source, r["rank"]), []).append(r.copy)
    assert all(sorted(n) == list(range(1, of[k].copies + 1)) for k, n in numbers.items())
    used = {}
    for r in of.values():
        used[tuple(r.row)] = used.get(tuple(r.row), 0) + 1
    assert all(n <= inputs[k] for k, n in used.items())
    per_key = lambda rows: sorted((str((r.doc_id, r.source)), r.copies) for r in rows if r.copies)
    assert sorted((str((r.row.doc_id, r.row.source)), r.copies) for r in of.values()) == per_key(
        mixing.mix(docs).collect())
    assert any(r.copies > 1 for r in of.values())
    last = dict(corpus_pipeline.STAGES)["mixing sources to target weights"](spark, docs, SMALL)
    assert last.columns == [*docs.columns, "size", "copies", "copy"] and last.count() == len(got)
    assert mixing.emit(empty(spark)).count() == 0 and mixing.digest(empty(spark)).count() == 0


def test_mixing_words_come_near_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), "en", f"s{i % 4}") for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    for r in got.groupBy("source", "target").sum("taken").collect():
        assert abs(r["sum(taken)"] - r["target"]) <= 0.01 * r["target"] + 200


def test_systematic_copies_by_hand(spark):
    """One source keeps its size; the copies are the integers that the prefix sums cross."""
    rows = [(i, "a b", "en", "only") for i in range(10)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert {r.copies for r in got.collect()} == {1}


def test_lines_awkward_rows_equal_sql(spark):
    rows = _unique(awkward_rows()) + [
        (20, "l1\nl2\nl3\nl4\nl1\nl2\nl3", "en", "a"), (21, "z\nl2\nl3\nl4", "en", "a"), (22, "l1\nl2", "en", "a"),
        (23, "\n\n\n\n\n", "en", "a"), (24, "q\nq\nq\nq\nq", "en", "a"), (25, "l2\r\nl3\r\nl4\r", "en", "a")]
    cols, want = _duck_rows(oracle.OP9, rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = line_dedup.dedup_lines(docs).select("row.doc_id", "row.text", "n_lines", "n_removed")
    assert _rows([r.asDict() for r in got.collect()], sorted(cols)) == \
        _rows([dict(zip(cols, r)) for r in want], sorted(cols))


def test_lines_repeated_ids_nulls_and_clashing_columns(spark):
    text = "a b\nc d\ne f"
    rows = [(5, text, "x"), (5, text, "y"), (5, "0\n" + text, "z"), (None, text, "n"), (6, None, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _d string")
    got = {r.row["_d"]: (r.row["text"], r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert len(got) == 5 and got["x"] == got["y"]          # equal rows are one document
    assert got["n"] == ("", 3, 3)                            # a null id sorts last
    assert got["w"] == (None, 0, 0)
    assert sorted([got["x"][2], got["z"][2]]) == [0, 3]      # one of the two texts with id 5 comes first
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_long_documents_lose_many_lines(spark):
    text = "\n".join(f"line {i % 4000} x" for i in range(12000))
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    got = {r.row["doc_id"]: (r.row["text"], r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert got[1][1:] == (12000, 8000)  # from the second round on every window repeats
    assert got[1][0].split("\n")[:4000] == [f"line {i} x" for i in range(4000)]
    assert got[2] == ("", 12000, 12000)
