"""Operator 2: URL filter: rules first, else logistic regression on hashed n-grams.

Rules are pairs of host and path with a verdict.  A rule fits its host and all
subdomains if the url's path starts with the rule's path; of the fitting rules
the longest wins.

Urls that no rule fits are judged by logistic regression on the hashed
character n-grams of host and path (host n-grams marked as such, with boundary
marks, so that the same letters in a path count apart).  The model is trained
on a small table of labelled urls, made by rule from general words, none of
which is taken from the pages; the regression is Spark's own.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule, and is judged on its empty features (the intercept); host letters A-Z
are lower-cased, nothing else is; rows that repeat an id each get a row; very
long urls are read whole; columns other than ``page_id`` and ``url`` are not
carried.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = (3, 4, 5)
FEATURES = 1 << 14


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: Fixed rules of the registered query
RULES = (
    Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"),
)

#: General words that unwanted and wanted hosts are made of (none is taken from the pages)
UNWANTED = (
    "casino poker slots bingo lottery jackpot betting bet gamble wager bonus spin winner win prize lucky "
    "porn sex xxx adult nude escort dating hookup cam erotic fetish viagra pills pharma steroid diet slim detox "
    "payday loan loans debt credit forex crypto bitcoin coin invest trader profit rich money cash earn "
    "spam ads adserver banner popup click traffic track tracker pixel affiliate seo backlink promo coupon deal "
    "cheap free discount replica outlet fake torrent crack keygen warez serial download stream hack cheat "
    "malware phish verify login-update giveaway miracle cure secret shocking viral clickbait psychic horoscope"
).split()
WANTED = (
    "news weather history science library university college school education museum theatre music travel garden "
    "recipes kitchen health hospital research journal archive forum letters wiki encyclopedia dictionary language "
    "city council government parliament nation station railway airport harbour bridge river mountain forest ocean "
    "nature animals birds flowers farmers market bakery coffee restaurant hotel family mother father brother children "
    "parents teacher student author poetry stories novel review magazine times herald tribune observer gazette "
    "sports football cricket tennis cycling running fitness software developer linux python data maths physics "
    "chemistry biology medicine astronomy engineering architecture painting gallery photography orchestra cathedral "
    "community charity foundation association society institute conference notation tradition exhibition"
).split()
#: how a host is made of one or two words, and the paths behind it; the first paths are for both kinds
HOSTS = ("{}.com", "www.{}.net", "{}.org", "blog.{}.info", "my{}.co", "{}24.com")
PAIRS = ("{}-{}.com", "www.{}{}.net", "{}-{}.info")
PATHS = ("/", "/index.html", "/page/{}", "/{}", "/a/{}.html")
UNWANTED_PATHS = ("/go/{}", "/click/{}", "/offer", "/signup-now", "/r/{}/win")
WANTED_PATHS = ("/about", "/articles/{}", "/archive/{}/", "/guide/{}", "/contact.html")


#: most hosts are names that are no word: wanted ones of two or three syllables, by rule
ONSETS = "b c d f g h k l m n p r s t th sh v w br st".split()
VOWELS = "a e i o u ea ou".split()
ENDS = ["", "n", "r", "s", "t", "l", "nd", "st", "ing", "ble", "ly"]
NAMES = 600


def names(n: int = NAMES) -> list[str]:
    def syllable(k: int) -> str:
        return (ONSETS[k % len(ONSETS)] + VOWELS[k // len(ONSETS) % len(VOWELS)]
                + ENDS[k // (len(ONSETS) * len(VOWELS)) % len(ENDS)])
    return [syllable(389 * k) + syllable(877 * k + 5) + (syllable(1237 * k + 11) if k % 3 == 0 else "") for k in range(n)]


def labelled_urls() -> list[tuple[str, float]]:
    """(url, 1.0 for unwanted): every word in every host frame, and next to a few others of its kind."""
    rows = [(f"http://{HOSTS[k % len(HOSTS)].format(w)}{(PATHS + WANTED_PATHS)[k % 10].format(31 * k % 997)}", 0.0)
            for k, w in enumerate(names())]
    for label, words, own in ((1.0, UNWANTED, UNWANTED_PATHS), (0.0, WANTED, WANTED_PATHS)):
        paths = PATHS + PATHS + own
        hosts = [f.format(w) for w in words for f in HOSTS]
        for i, w in enumerate(words):
            others = [words[(i + step) % len(words)] for step in (1, 7, 31)]
            hosts += [f.format(w, other) for f, other in zip(PAIRS, others)]
        for k, host in enumerate(hosts):
            rows.append((f"http{'s' * (k % 2)}://{host}" + paths[k % len(paths)].format(31 * k % 997), label))
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Rule string and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _marked_grams(text: Column, mark: str) -> Column:
    """All n-grams of a text, each behind its mark; linear in the text, however long it is."""
    chars = F.split(text, "")

    def grams(n: int) -> Column:
        many = F.greatest(F.size(chars) - n + 1, F.lit(0))
        shifted = F.arrays_zip(*[F.slice(chars, k + 1, many).alias(f"c{k}") for k in range(n)])
        return F.transform(shifted, lambda x: F.concat(F.lit(mark), *[x[f"c{k}"] for k in range(n)]))

    return F.concat(*[grams(n) for n in SIZES])


def features(df: DataFrame) -> DataFrame:
    """``df`` (with ``host`` and ``path``) with the vector ``features``."""
    grams = F.array_distinct(F.concat(_marked_grams(F.concat(F.lit("^"), "host", F.lit("$")), "h:"),
                                      _marked_grams(F.concat("path", F.lit("$")), "p:")))
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="features")
    return hashing.transform(df.withColumn("_grams", grams)).drop("_grams")


def train(spark: SparkSession, labelled: DataFrame | None = None) -> LogisticRegressionModel:
    """Fit on a table of ``url, label``; the built-in one has ``len(labelled_urls())`` rows."""
    if labelled is None:
        labelled = spark.createDataFrame(labelled_urls(), "url string, label double")
    host, path = host_and_path(F.col("url"))
    rows = features(labelled.select(host.alias("host"), path.alias("path"), "label").coalesce(1))
    return LogisticRegression(maxIter=50, regParam=0.01, aggregationDepth=2).fit(rows)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` (score: probability of unwanted)."""
    model = train(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    made = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    scored = model.transform(features(made))
    score = vector_to_array("probability").getItem(1)
    return scored.select("page_id", "host", "path", name.alias("rule"),
                         F.coalesce(verdict, F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"),
                         score.alias("score"))
