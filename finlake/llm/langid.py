"""Operator 8: language identification by multilingual mixture inference.

Model: per language the smoothed probabilities of letter trigrams (lower-cased,
word boundaries included, hashed to ``BUCKETS`` buckets), counted over all
labelled training documents.

Inference: every word of a document is drawn from one language, with the
language's n-gram likelihood; the languages' proportions are estimated by
expectation-maximisation.  The language set starts with the single most likely
language and grows by the language that raises the likelihood most, as long as
the raise is above a penalty of ``PENALTY * ln(words)`` per language.  The
log-likelihood is concave in the proportions, so a language whose derivative at
share zero is not positive is left out without a trial.

The predicted language is the one with the largest share (ties: smallest name);
the score is that share.

A text's letters are worked off in pieces and its words' likelihoods are held
only up to ``HELD`` numbers, so long texts, long words and many languages cost
time, not memory.

Defined cases: null text or text without a letter gives ``und`` with score 0;
texts are read whole; without a training document every text gives ``und``;
rows that repeat an id each get a row; columns called like the results are not
carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.store import is_held_out, per_text, ship
from finlake.llm.text import _alpha, code_points

BUCKETS = 1 << 16
#: Dirichlet smoothing per bucket
ALPHA = 0.05
PENALTY = 3.0
#: languages whose probabilities travel together: 16 MB a block; a Python worker holds all blocks, 256 KB a language
BLOCK = 64
UNKNOWN = "und"
#: code points looked at together, and likelihoods (letters x languages, words x languages) held together
CHUNK, HELD = 1 << 20, 1 << 22


def letter_chunks(codes: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A bucket per letter (with its neighbours in the word), and which letters begin a word, piece by piece.

    A piece sees the code point on either side of it, so a word that runs on into
    the next piece, however long, has the same buckets as in one piece.
    """
    step = max(1, min(CHUNK, HELD // max(width, 1)))
    for low in range(0, len(codes), step):
        high = min(low + step, len(codes))
        c = codes[max(low - 1, 0):high + 1]
        letter = _alpha()[c]
        c = np.where(letter, c, np.uint32(0))
        c = np.concatenate((np.zeros(int(low == 0), np.uint32), c, np.zeros(int(high == len(codes)), np.uint32)))
        before, own, after = c[:-2], c[1:-1], c[2:]
        at = own != 0
        before, own, after = before[at], own[at], after[at]
        h = before * np.uint32(0x9E3779B1) ^ own * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        yield (h >> np.uint32(16)).astype(np.int64), before == 0


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all documents with a language."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def flushed(counts):
            for lang, seen in counts.items():
                at = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(seen[at])],
                    names=["lang", "bucket", "n"])
            counts.clear()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                for h, _ in letter_chunks(code_points(text), 1):
                    if len(h):
                        seen = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                        seen += np.bincount(h, minlength=BUCKETS)
                        if len(counts) > BLOCK:  # a task holds the counts of a few languages at a time
                            yield from flushed(counts)
        yield from flushed(counts)

    ship(docs.sparkSession)
    part = docs.filter("lang is not null and text is not null").select("lang", "text")
    return part.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in name order and log probabilities, ``BUCKETS`` x languages (float32).

    The driver gets at most ``BUCKETS`` counts per language, however many
    documents there are.
    """
    rows = trigram_counts(docs).toArrow()
    langs = sorted(set(rows.column("lang").to_pylist()))
    n = np.zeros((BUCKETS, len(langs)))
    place = {lang: k for k, lang in enumerate(langs)}
    n[rows.column("bucket").to_numpy(), [place[x] for x in rows.column("lang").to_pylist()]] = rows.column("n").to_numpy()
    return langs, np.log((n + ALPHA) / (n.sum(axis=0) + ALPHA * BUCKETS)).astype(np.float32)


def blocks_of(model: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(model[:, k:k + BLOCK]) for k in range(0, model.shape[1], BLOCK)]


def word_blocks(codes: np.ndarray, blocks: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Log-likelihoods of the words (rows) in each language (columns), some words at a time."""
    width, open_word = sum(b.shape[1] for b in blocks), None
    for h, begins in letter_chunks(codes, width):
        if not len(h):
            continue
        cut = np.flatnonzero(begins)
        if not begins[0]:
            cut = np.concatenate(([0], cut))
        sums = np.concatenate([np.add.reduceat(b[h], cut, axis=0) for b in blocks], axis=1)
        if open_word is not None:
            if begins[0]:
                yield open_word
            else:  # the word of the piece before goes on
                sums[0] += open_word[0]
        open_word = sums[-1:]
        if len(sums) > 1:
            yield sums[:-1]
    if open_word is not None:
        yield open_word


def word_likelihoods(text: str | None, model: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word (rows) in each language (columns)."""
    out = list(word_blocks(code_points(text), blocks_of(model)))
    return np.concatenate(out) if out else np.zeros((0, model.shape[1]), np.float32)


class Mixture:
    """A text's words as the mixture inference sees them: likelihoods over the word's best language.

    A text of up to ``HELD`` likelihoods keeps them; those of a longer one are
    worked out again for each pass, so memory grows with the text's own size only.
    """

    def __init__(self, parts: Callable[[], Iterable[np.ndarray]], width: int):
        self.parts, self.width, self.n, self.logs = parts, width, 0, np.zeros(width)
        self.kept: list[np.ndarray] | None = []
        for ll in parts():
            self.n += len(ll)
            self.logs += ll.sum(axis=0, dtype=np.float64)
            if self.kept is not None:
                self.kept.append(self._relative(ll))
                if self.n * width > HELD:
                    self.kept = None
        if self.kept:
            self.kept = [np.concatenate(self.kept)]

    @staticmethod
    def _relative(ll: np.ndarray) -> np.ndarray:
        return np.maximum(np.exp((ll - ll.max(axis=1, keepdims=True)).astype(np.float64)), 1e-30)

    def each(self, columns: list[int] | slice = slice(None)) -> Iterator[np.ndarray]:
        for p in self.kept if self.kept is not None else map(self._relative, self.parts()):
            yield p[:, columns]


def expectation_maximisation(p: np.ndarray | Mixture, rounds: int = 50, least: float = 1e-4,
                             columns: list[int] | slice = slice(None)) -> tuple[np.ndarray, float]:
    """Shares of the columns of ``p`` and the log-likelihood they give."""
    if isinstance(p, np.ndarray):
        whole = p
        passes, n, width = lambda: [whole[:, columns]], len(whole), whole[:, columns].shape[1]
    else:
        passes, n = lambda: p.each(columns), p.n
        width = p.width if isinstance(columns, slice) else len(columns)
    share = np.full(width, 1 / width)
    last = -np.inf
    for _ in range(rounds):
        total, pull = 0.0, np.zeros(width)
        for part in passes():
            mix = part @ share
            total += float(np.log(mix).sum())
            pull += (part / mix[:, None]).sum(axis=0)
        if total - last < least * max(1.0, np.log(n)):
            break
        share, last = share * pull / n, total
    return share, total


def languages(ll: np.ndarray | Mixture) -> tuple[list[int], np.ndarray]:
    """The chosen columns and their shares."""
    if isinstance(ll, np.ndarray):
        whole = ll
        ll = Mixture(lambda: [whole], whole.shape[1])
    chosen, share = [int(np.argmax(ll.logs))], np.ones(1)
    price = PENALTY * np.log(max(ll.n, 2))
    best = sum(float(np.log(p[:, 0]).sum()) for p in ll.each(chosen))
    while len(chosen) < ll.width:
        slope = np.full(ll.width, -float(ll.n))
        for p in ll.each():
            slope += (p / (p[:, chosen] @ share)[:, None]).sum(axis=0)
        tries = [k for k in np.argsort(-slope, kind="stable").tolist() if k not in chosen and slope[k] > 0]
        found = max(((*expectation_maximisation(ll, columns=[*chosen, k]), k) for k in tries),
                    key=lambda x: (x[1], -x[2]), default=None)
        if found is None or found[1] - best <= price:
            break
        share, best = found[0], found[1]
        chosen.append(found[2])
    return chosen, share


def identify(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """``docs`` without text, with ``lang_pred``, ``score`` and ``lang_mix`` (languages in order of share)."""
    given = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks_of(model)]  # 256 KB a language

    def one(text):
        if not langs:
            return UNKNOWN, 0.0, []
        codes, blocks = code_points(text), [g.value for g in given]
        words = Mixture(lambda: word_blocks(codes, blocks), len(langs))
        if not words.n:
            return UNKNOWN, 0.0, []
        chosen, share = languages(words)
        order = sorted(range(len(chosen)), key=lambda k: (-share[k], langs[chosen[k]]))
        return langs[chosen[order[0]]], min(float(share[order[0]]), 1.0), [langs[chosen[k]] for k in order]

    def run(texts):
        return list(zip(*map(one, texts))) if texts else [[], [], []]

    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_mix")]
    return per_text(docs.select(keep), run, "lang_pred string, score double, lang_mix array<string>")


def language_id(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out, then predict every row."""
    langs, model = train(docs.filter(~is_held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    return identify(docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text"), langs, model)
