"""Operator 5: personal data by weak supervision, in DataFrame operations only.

Base spans come from four patterns with checks (``BASE``); they always stay.
Further spans are candidates of wider patterns (``WIDE``: numbers without the
strict form, e-mail addresses spelt out) that four labelers vote on:

* form: a regular expression for the usual grouping,
* gazetteer: issuer prefixes, dialling codes, top-level domains,
* context: telling words shortly before the span, or words that tell against,
* check: Luhn, digit counts, number ranges.

A vote is 1 (personal), -1 (not) or 0 (abstains).  Expectation-maximisation
over the counts of vote patterns estimates, per kind, the labelers'
reliabilities and each pattern's probability; a logistic span classifier is
then trained on those probabilities with the votes and the span's length as
features, and its weights become a Column expression.  The driver sees only
the pattern counts, at most ``4 kinds * 3^4 votes * 4 lengths`` rows however
many documents there are.

Positions: ``regexp_extract_all`` gives the matches and ``split`` with the same
pattern the gaps between them; sums of their lengths are the starts, in code
points.  Spans live in arrays on the document's row, so nothing is shuffled.

Defined cases: null text counts as empty; texts are read whole, and the
patterns are possessive or anchored so that long runs of one character class
cost linear time and no recursion; rows that repeat an id each get a row; an
empty table, or one without candidates, adds no span; columns other than
``doc_id`` are not carried.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.store import stored

# ---- fixed values ---------------------------------------------------------------------------------
KINDS = ("email", "ip", "card", "phone")
#: A base match starts leftmost; for runs of one class that means: not inside the run, unless a match just ended there.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: cheap tests that every text with such a match passes
HINT = {
    "email": r"@[A-Za-z0-9-]+\.[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9][\x20().0-9-]",
}
#: candidates of the method, wider than the base patterns
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]+"
             r"(?:(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9A-Za-z])[0-9]{1,3}(?:\x20?[.,]\x20?[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20.-]{0,2}[0-9]){12,}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])[(0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])",
}
WIDE_HINT = {
    "email": r"(?:[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:\x20?[(\[]dot[)\]]|\x20dot\x20|\.[A-Za-z0-9-])",
    "ip": r"[0-9]\x20?[.,]\x20?[0-9]{1,3}\x20?[.,]\x20?[0-9]{1,3}\x20?[.,]",
    "card": r"[0-9](?:[\x20.-]{0,2}[0-9]){12}",
    "phone": r"[(0-9](?:[\x20().-]{0,2}[0-9]){6}",
}
FORM = {
    "email": r"[(\[]at[)\]].*[(\[]dot[)\]]",
    "ip": r"^[0-9]+(?:\.[0-9]+){3}$",
    "card": r"^(?:[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$",
    "phone": r"^(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|0[0-9]{2,4}[\x20.-][0-9]{5,8})$",
}
GAZETTEER = {
    "email": r"(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?:10|127|172|192)\D",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)",
    "phone": r"^\(?(?:001|0033|0034|0044|0049|212|310|415|555|617|800|888)",
}
CONTEXT_FOR = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach|correo|kontakt|courriel)",
    "ip": r"(?i)(?:\bip\b|host|server|address|login|adresse|direcci)",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell|telefon|appel|llama)",
}
CONTEXT_AGAINST = r"(?i)(?:order|invoice|isbn|version|token|key|serial|\bid\b|hash|=|#|total|page)\W*$"
#: code points before a span that the context labeler reads
CONTEXT = 32
# ---------------------------------------------------------------------------------------------------

LABELERS = ("form", "gazetteer", "context", "check")
ROUNDS = 60


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a string of digits passes the Luhn check."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        x = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = x * 2
        return F.when(i % 2 == 1, x).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), part)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _parts_at_most(value: Column, most: int, separator: str = r"[^0-9]+") -> Column:
    """Every number in the value is at most ``most``, whatever its leading zeros."""
    return F.forall(F.split(value, separator), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
                    & (F.coalesce(F.substr(F.concat(F.lit("000"), p), F.lit(-3), F.lit(3)).try_cast("int"), F.lit(0))
                       <= most))


CHECK = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: _parts_at_most(v, 255, r"\."),
    "card": lambda v: F.length(_digits(v)).between(13, 19) & luhn(_digits(v)),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def matches(text: Column, pattern: str, hint: str) -> Column:
    """All matches as array<struct<start, end, value>>, positions in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # one more than there are matches
    pairs = F.zip_with(gaps, found, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("n")))
    # the running position adds up once; nothing inside a lambda looks at the text again
    walked = F.aggregate(
        F.filter(pairs, lambda x: x["n"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda a, x: F.struct((a["at"] + x["gap"] + x["n"]).alias("at"),
                              F.array_append(a["starts"], a["at"] + x["gap"]).alias("starts")))
    spans = F.zip_with(walked["starts"], found, lambda s, v: F.struct(
        s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(hint), spans).otherwise(none)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(matches(text, BASE[kind], HINT[kind]), lambda s: CHECK[kind](s["value"]))


def _check_vote(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(CHECK["card"](value), 1).otherwise(-1)
    if kind == "phone":
        return F.when(n.between(10, 11), 1).when(n > 15, -1).otherwise(0)
    if kind == "ip":
        return F.when(_parts_at_most(value, 255), 1).otherwise(-1)
    return F.when(F.length(value) <= 80, 0).otherwise(-1)


def candidates(text: Column, kind: str, base: list[str]) -> Column:
    """Wide matches clear of every base span, with the labelers' votes and a length class."""
    def vote(s: Column) -> Column:
        v = s["value"]
        before = F.substr(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
        return F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.when(v.rlike(FORM[kind]), 1).otherwise(0).alias("form"),
            F.when(v.rlike(GAZETTEER[kind]), 1).otherwise(-1 if kind in ("card", "email") else 0).alias("gazetteer"),
            F.when(before.rlike(CONTEXT_AGAINST), -1).when(before.rlike(CONTEXT_FOR[kind]), 1).otherwise(0)
            .alias("context"),
            _check_vote(kind, v).alias("check"),
            F.least(F.floor(F.length(v) / 8), F.lit(3)).cast("int").alias("size"))

    free = F.filter(matches(text, WIDE[kind], WIDE_HINT[kind]), lambda s: ~F.exists(
        F.concat(*[F.col(b) for b in base]), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.transform(free, vote)


class Pattern(NamedTuple):
    kind: str
    votes: tuple[int, ...]
    size: int


def posteriors(counts: dict[Pattern, int], rounds: int = ROUNDS) -> dict[Pattern, float]:
    """Probability of each vote pattern being personal data, per kind, by expectation-maximisation.

    Two classes; given the class the labelers vote independently.  The start is
    the majority vote; add-one smoothing keeps every reliability away from 0 and 1.
    """
    out: dict[Pattern, float] = {}
    for kind in KINDS:
        own = {p: n for p, n in counts.items() if p.kind == kind}
        if not own:
            continue
        post = {p: 1 / (1 + math.exp(-1.5 * sum(p.votes) + 1.0)) for p in own}
        for _ in range(rounds):
            mass = [sum(n * (post[p] if c else 1 - post[p]) for p, n in own.items()) for c in (0, 1)]
            prior = (mass[1] + 1) / (mass[0] + mass[1] + 2)
            table = [[{v: (1 + (c == 1) * (v == 1) + (c == 0) * (v == -1) + sum(
                n * (post[p] if c else 1 - post[p]) for p, n in own.items() if p.votes[k] == v)) / (mass[c] + 4)
                for v in (-1, 0, 1)} for k in range(len(LABELERS))] for c in (0, 1)]
            for p in own:
                odds = math.log(prior / (1 - prior)) + sum(
                    math.log(table[1][k][v] / table[0][k][v]) for k, v in enumerate(p.votes))
                post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        out |= post
    return out


def _features(p: Pattern) -> list[float]:
    return [1.0, *map(float, p.votes), *(float(v != 0) for v in p.votes), p.size / 3]


def train(counts: dict[Pattern, int], post: dict[Pattern, float], steps: int = 400) -> dict[str, list[float]]:
    """Per kind the weights of a logistic classifier fitted to the posteriors, each pattern weighing its count."""
    weights: dict[str, list[float]] = {}
    for kind in KINDS:
        own = [(_features(p), post[p], math.sqrt(n)) for p, n in sorted(counts.items()) if p.kind == kind]
        if not own:
            continue
        total, w = sum(n for *_, n in own), [0.0] * len(own[0][0])
        for _ in range(steps):
            slope = [0.01 * x for x in w]
            for f, y, n in own:
                z = sum(a * b for a, b in zip(w, f))
                gap = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y) * n / total
                slope = [s + gap * x for s, x in zip(slope, f)]
            w = [a - 0.5 * s for a, s in zip(w, slope)]
        weights[kind] = w
    return weights


def _bare(spans: Column | str, kind: str) -> Column:
    """The spans of one kind without their values."""
    # one-argument lambdas: a second parameter would be read as the index
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                 s["end"].alias("end")))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _by_start(spans: Column) -> Column:
    return F.array_sort(spans, lambda a, b: F.when(a["start"] < b["start"], -1).when(
        a["start"] > b["start"], 1).otherwise(0))


def _accepted(s: Column, weights: dict[str, list[float]]) -> Column:
    """The classifier's decision on one candidate as an expression."""
    out = F.lit(False)
    for kind, w in weights.items():
        z = F.lit(w[0]) + w[-1] * s["size"] / 3
        for k, name in enumerate(LABELERS):
            z = z + w[1 + k] * s[name] + w[1 + len(LABELERS) + k] * F.when(s[name] != 0, 1.0).otherwise(0.0)
        out = F.when(s["kind"] == kind, z >= 0).otherwise(out)
    return out


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of base spans, ``base_sha256``, ``spans`` (all spans) and ``n_added`` per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text"))
    found = found.select("doc_id", "text", *[base_spans(F.col("text"), k).alias(k) for k in KINDS])
    found = stored(found.select(
        "doc_id", *[_bare(k, k).alias(k) for k in KINDS],
        F.concat(*[candidates(F.col("text"), k, list(KINDS)) for k in KINDS]).alias("more")), "spans")
    seen = found.select(F.explode("more").alias("s")).groupBy(
        "s.kind", *[f"s.{x}" for x in LABELERS], "s.size").count().collect()
    counts = {Pattern(r["kind"], tuple(r[x] for x in LABELERS), r["size"]): r["count"] for r in seen}
    weights = train(counts, posteriors(counts))
    added = F.filter("more", lambda s: _accepted(s, weights))
    slim = F.transform(added, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    every = F.flatten(F.array(*[_by_start(F.concat(F.col(k), _of_kind(slim, k))) for k in KINDS]))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.concat(*KINDS)), 256).alias("base_sha256"), _joined(every).alias("spans"),
        F.size(added).cast("long").alias("n_added"))
