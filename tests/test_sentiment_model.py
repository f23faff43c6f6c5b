"""The trained scorer against a dictionary version, and on headlines whose words tell the label."""

import hashlib
import math
import random
import re
from collections import Counter

from finlake.plans import sentiment_model as M

SCHEMA = "doc_id long, date date, symbol string, title string, sentiment string"


def buckets_of(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % M.BUCKETS for w in words]


def fixed(x):
    return round(x * M.UNIT)


def slow(rows, texts):
    """rows: (text, label) -> [(label, margin)] of texts"""
    rows = [(buckets_of(t), c) for t, c in rows if c is not None]
    n = Counter(c for _, c in rows)
    df = Counter(b for w, _ in rows for b in set(w))
    idf = {b: fixed(math.log((len(rows) + 1) / (k + 1)) + 1) for b, k in df.items()}
    s = {c: Counter() for c in n}
    for w, c in rows:
        for b in w:
            s[c][b] += idf[b]
    out = []
    for t in texts:
        x = {c: fixed(math.log(n[c] / len(rows))) * M.UNIT + sum(
            idf[b] * fixed(math.log((s[c][b] + M.UNIT) / (sum(s[c].values()) + len(idf) * M.UNIT)))
            for b in buckets_of(t) if b in idf) for c in n}
        best = sorted(x, key=lambda c: (-x[c], c))
        out.append((best[0], (x[best[0]] - x[best[1]]) / M.UNIT ** 2 if len(best) > 1 else None))
    return out


def scored(spark, rows, texts):
    model = M.fit(spark.createDataFrame(rows, "title string, sentiment string"))
    got = M.score(spark.createDataFrame(list(enumerate(texts)), "k int, title string"), model).orderBy("k").collect()
    return [(r.sentiment, r.margin) for r in got]


def test_equals_a_dictionary_version(spark):
    rows = [("Profit rises, profit beats!", "positive"), ("Lawsuit: losses and a lawsuit", "negative"), ("Meeting", "neutral"),
            ("Étude du marché 2024", "neutral"), (None, "neutral"), ("", "positive"), ("not learned", None)]
    texts = ["profit", "a LAWSUIT profit", "unseen words", None, "", "MEETING étude", "not learned", "losses " * 500]
    assert scored(spark, rows, texts) == slow(rows, texts)


def test_ties_one_label_and_no_label(spark):
    assert scored(spark, [("a", "x"), ("b", "w")], ["c", "a"])[0] == ("w", 0.0)      # a tie: first in order
    assert scored(spark, [("a", "x")], ["a", None]) == [("x", None), ("x", None)]
    assert scored(spark, [("a", None)], ["a"]) == [(None, None)]


def test_held_out_headlines(spark):
    """Headlines of common words with a few telling ones: the held-out fold is labelled right."""
    r = random.Random(4)
    common = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    telling = {"positive": ["surge", "record", "beat"], "negative": ["fraud", "loss", "cut"], "neutral": ["meeting", "holds"]}
    rows = []
    for i in range(1500):
        c = r.choice(list(telling))
        words = r.choices(common, k=8) + r.choices(telling[c], k=2)
        r.shuffle(words)
        rows.append((i, None, "S", " ".join(words), c))
    out = M.scored_headlines(spark.createDataFrame(rows, SCHEMA))
    cells = {(x.held_out, x.label, x.sentiment): x.n for x in M.confusion(out).collect()}
    held = sum(n for (h, *_), n in cells.items() if h)
    right = sum(n for (h, a, b), n in cells.items() if h and a == b)
    assert sum(cells.values()) == 1500 and 200 < held < 400 and right / held > 0.97


def test_repeated_and_null_keys(spark):
    rows = [(1, None, "S", "up up", "positive"), (1, None, "S", "up up", "positive"), (None, None, "S", "down", "negative"),
            (2, None, None, None, "positive")]
    assert M.scored_headlines(spark.createDataFrame(rows, SCHEMA)).count() == 4


def test_empty_table(spark):
    assert M.scored_headlines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_global_positions(spark):
    from finlake.operators.ordinals import global_positions

    for values in ([f"v{i * 37 % 500}" for i in range(500)] + [None], ["b"], [None], []):
        df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
        got = {r.v: r.p for r in global_positions(df, "v", "p").collect()}
        order = sorted((v for v in values if v is not None)) + [v for v in values if v is None]
        assert got == {v: i for i, v in enumerate(order)}


def test_codes_come_without_a_window_over_everything(spark):
    import __spark_entry__ as entry
    from tools.plan_report import plan_text

    from .conftest import SF_SMALL

    df = entry.queries()["ordinal_encoded"](spark, SF_SMALL)
    df.collect()
    numbered = re.findall(r"row_number\(\) windowspecdefinition\((\w+)", plan_text(df))
    assert numbered and set(numbered) == {"_part"}
