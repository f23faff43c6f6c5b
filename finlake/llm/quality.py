"""Operator 6: quality rules as a short-circuit cascade.

Every text is measured first (words, word characters, symbols, duplicate lines,
repeated five-word windows); two base rules on those numbers reject at once.
The method's rules then run as a cascade: each rule's cost (nanoseconds) and
selectivity (share of texts it rejects) are measured in tasks over a sample of
the documents, and the rules run in the order of rejections per cost until one
rejects.  The rules are a conjunction, so the order changes the time a text
takes and never its verdict.

The sample: documents whose id hashes into one of ``SAMPLE_PARTS`` parts, the
part count growing with the table so that about ``SAMPLE_ROWS`` texts are
timed.  Only the order of the rules comes from it.

Defined cases: null and empty texts have no words and are rejected by the base
rule; texts are read whole; rows that repeat an id each get a row; a table that
yields no sample runs the rules in the order listed; columns of the input other
than ``doc_id`` are not carried.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.store import per_text

SAMPLE_ROWS = 2000

# Fixed values of the base rules
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20

# Fixed thresholds of the cascade, set where prose stays well clear of them
MAX_SYMBOLS_PER_WORD = 0.2
MAX_SHOUTED_PER_WORD = 0.3
MAX_EXCLAMATIONS_PER_WORD = 0.3
MAX_SAME_NEIGHBOURS = 0.3
MAX_DUP_LINES = 0.5
MIN_LETTER_SHARE = 0.5
MEAN_WORD = (2.0, 20.0)


class Measured(NamedTuple):
    """What the rules read: the text's bytes, its words, and the base numbers."""

    text: str
    words: list[bytes]
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that stand in the text twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    flat, place, at = b" ".join(words), [], 0
    for w in words:
        place.append(at)
        at += len(w) + 1
    place.append(at)
    keys = [flat[place[i]:place[i + width] - 1] for i in range(n)]
    seen = Counter(keys)
    if len(seen) == n:
        return 0
    covered = upto = 0
    for i, k in enumerate(keys):
        if seen[k] > 1:
            covered += i + width - max(i, upto)
            upto = i + width
    return covered


def measure(text: str | None) -> Measured:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at blank, tab, line feed, vertical tab, form feed, carriage return
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return Measured(text, words, len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)),
                    len(lines) - len(set(lines)), repeated_words(words), len(lines))


def _symbols(m: Measured) -> bool:
    return m.n_symbols > MAX_SYMBOLS_PER_WORD * m.n_words


def _word_length(m: Measured) -> bool:
    return not MEAN_WORD[0] <= m.word_chars / m.n_words <= MEAN_WORD[1]


def _exclamations(m: Measured) -> bool:
    return m.text.count("!") > MAX_EXCLAMATIONS_PER_WORD * m.n_words


def _dup_lines(m: Measured) -> bool:
    return m.n_dup_lines > MAX_DUP_LINES * m.n_lines


def _shouted(m: Measured) -> bool:
    return sum(w.isupper() and len(w) > 1 for w in m.words) > MAX_SHOUTED_PER_WORD * m.n_words


def _same_neighbours(m: Measured) -> bool:
    return sum(a == b for a, b in zip(m.words, m.words[1:])) > MAX_SAME_NEIGHBOURS * m.n_words


def _letters(m: Measured) -> bool:
    return sum(map(str.isalpha, m.text)) < MIN_LETTER_SHARE * m.word_chars


#: name and test (true: reject); a rule sees only texts with at least one word
RULES: list[tuple[str, Callable[[Measured], bool]]] = [
    ("symbols", _symbols), ("word_length", _word_length), ("exclamations", _exclamations),
    ("dup_lines", _dup_lines), ("shouted", _shouted), ("same_neighbours", _same_neighbours), ("letters", _letters),
]


def rule_order(docs: DataFrame) -> list[int]:
    """Positions in ``RULES`` by rejections per nanosecond, measured on the sample."""
    n = docs.count()
    parts = max(1, n // SAMPLE_ROWS)
    sample = docs.filter(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(parts)) == 0).select("text")

    def run(texts):
        out = []
        for m in map(measure, texts):
            if m.base_failed:  # the cascade never sees it
                continue
            for k, (_, rule) in enumerate(RULES):
                began = time.perf_counter_ns()
                bad = rule(m)
                out.append((k, time.perf_counter_ns() - began, int(bad)))
        return list(zip(*out)) if out else [[], [], []]

    timed = per_text(sample, run, "rule int, cost long, bad long").groupBy("rule").agg(
        F.avg("cost").alias("cost"), F.avg("bad").alias("bad")).collect()  # a row per rule
    worth = {r["rule"]: r["bad"] / max(r["cost"], 1.0) for r in timed}
    return sorted(range(len(RULES)), key=lambda k: (-worth.get(k, 0.0), k))


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` per document."""
    order = rule_order(docs)

    def run(texts):
        out = []
        for m in map(measure, texts):
            kept = not m.base_failed and not any(RULES[k][1](m) for k in order)  # any() stops at the first
            out.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed, kept))
        return list(zip(*out)) if out else [[]] * 7

    return per_text(docs.select("doc_id", "text"), run,
                    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                    "base_failed boolean, kept boolean")
