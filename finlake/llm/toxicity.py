"""Operator 3: toxicity by a bidirectional GRU with attention pooling, in numpy.

A word's input is a learned vector for the word (hashed) and the pooled learned
vectors of its character 3- and 5-grams (hashed, with word boundaries): the
largest value over the grams in half of the dimensions, the mean in the others.
Words and grams of fewer than ``LEAST_SEEN`` training documents have no vector,
so that the model can't learn single documents by heart.
A window of words runs through a forward and a backward gated recurrent
network; attention weighs the states, their weighted sum gives the window's
logit.  All overlapping windows of every whole text are scored; the document's
score is calibrated from its largest window logit, its mean window probability
and its number of windows.

Training takes at most ``TRAIN_ROWS`` labelled rows per class (by hash order of
the id), and all overlapping windows of each.  The label belongs to the
document, so after two rounds on all windows the network trains on the window
that scores highest in its document (multiple-instance learning).  Windows are
cut, counted and scored in Spark tasks and stored; the driver streams them in
batches in the first rounds and gets one window per row in the later ones, so
its memory doesn't grow with the texts.  One dimension of the word and
character vectors starts from the smoothed log-odds of the two classes in the
training rows.  Every fourth training row is kept from the network and
calibrates its logits, over all windows of its text.

Defined cases: null and empty texts, or texts without a letter or digit, score
0; without training rows of both classes every text scores 0; rows that repeat
an id each get a row; an id labelled both ways counts as toxic; a row without id
is never trained on and counts as not held out; columns other than ``doc_id``
and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.store import is_held_out, per_text, ship, stored
from finlake.llm.text import code_points, mixed, word_hashes, word_runs

#: words per window, and from one window's start to the next: half a window, so a phrase of 24 words is whole in one
WINDOW, STEP = 48, 24
#: bound of the training sample: rows per class
TRAIN_ROWS = 1500
WORD_BUCKETS, GRAM_BUCKETS = 1 << 14, 1 << 15
WORD_DIM, GRAM_DIM, HIDDEN, ATTENTION = 8, 8, 12, 8
#: dimensions of the grams pooled by maximum; the others by mean
MAX_DIM = 4
#: training documents that a word or gram needs
LEAST_SEEN = 3
#: log-odds seen in as many documents count half
SHRINK = 10
#: rounds; the first ones train on all windows, the others on each document's highest, chosen anew every second round
ROUNDS, ON_ALL, BATCH, RATE = 10, 2, 128, 0.01
#: words whose inputs are held at a time
CHUNK = 1 << 15
#: words of many texts whose inputs are made once per different word
TOGETHER = 1 << 17
_BOUNDARY = np.uint32(1)


class Words:
    """A text's words as bucket numbers: one per word, and its character grams."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.n = len(starts)
        self.word = (word_hashes(codes, starts, ends) >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS
        size = ends - starts
        padded = np.maximum(size + 2, 5)
        first = np.cumsum(padded) - padded
        chars = np.full(int(padded.sum()), _BOUNDARY, np.uint32)
        at = np.arange(int(size.sum())) + np.repeat(starts - np.cumsum(size) + size, size)
        chars[at - np.repeat(starts - first - 1, size)] = codes[at]
        grams, counts = [], []
        for width in (3, 5):
            n = padded - width + 1
            begin = np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n)
            h = np.full(len(begin), width, np.uint64)
            for k in range(width):
                h = h * np.uint64(0x100000001B3) + chars[begin + k]
            grams.append((mixed(h) >> np.uint64(40)).astype(np.int64) % GRAM_BUCKETS)
            counts.append(n)
        self.grams, self.counts = grams, counts

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        """words x (WORD_DIM + GRAM_DIM)"""
        total, most = 0, -np.inf
        for g, n in zip(self.grams, self.counts):
            v, first = p["grams"][g], np.cumsum(n) - n
            total = total + np.add.reduceat(v[:, MAX_DIM:], first, axis=0)
            most = np.maximum(most, np.maximum.reduceat(v[:, :MAX_DIM], first, axis=0))
        mean = total / (self.counts[0] + self.counts[1])[:, None]
        return np.concatenate([p["words"][self.word], most, mean], axis=1).astype(np.float32)


def windows(n: int) -> np.ndarray:
    """Starts of the windows over ``n`` words; the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64)
    starts = np.arange(0, n - WINDOW + STEP, STEP)
    starts[-1] = n - WINDOW
    return np.unique(np.minimum(starts, n - WINDOW))


class Piece(NamedTuple):
    """Words of a text, by their places in its code points, and the window starts inside the piece."""

    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    windows: np.ndarray


def pieces(text: str | None) -> Iterator[Piece]:
    """Pieces of a text; they overlap so that no window is cut."""
    codes = code_points(text)
    starts, ends = word_runs(codes)
    every = windows(len(starts))
    low = 0
    while low < len(every):
        high = int(np.searchsorted(every, every[low] + CHUNK))
        base = int(every[low])
        stop = min(len(starts), int(every[high - 1]) + WINDOW)
        first, last = int(starts[base]), int(ends[stop - 1])
        yield Piece(codes[first:last], starts[base:stop] - first, ends[base:stop] - first, every[low:high] - base)
        low = high


def word_chunks(text: str | None) -> Iterator[tuple[Words, np.ndarray]]:
    """The words and window starts of each piece of a text."""
    for p in pieces(text):
        yield Words(p.codes, p.starts, p.ends), p.windows


def projected_once(p: dict[str, np.ndarray], held: list[Piece]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per piece the network's input of each different word of all pieces, and which one each of its words has."""
    h = np.concatenate([word_hashes(x.codes, x.starts, x.ends) for x in held])
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    shift = np.cumsum([0] + [len(x.codes) for x in held[:-1]])
    starts, ends = (np.concatenate([v + k for v, k in zip(part, shift)])[first]
                    for part in ([x.starts for x in held], [x.ends for x in held]))
    projected = Words(np.concatenate([x.codes for x in held]), starts, ends).inputs(p) @ p["w"] + p["b"]
    low = 0
    for x in held:
        yield projected, which[low:low + len(x.starts)]
        low += len(x.starts)


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    d, h = WORD_DIM + GRAM_DIM, HIDDEN

    def normal(scale, *shape):
        return (r.standard_normal(shape) * scale).astype(np.float32)

    return {
        "words": normal(0.1, WORD_BUCKETS, WORD_DIM), "grams": normal(0.1, GRAM_BUCKETS, GRAM_DIM),
        "w": normal(d**-0.5, d, 6 * h), "b": np.zeros(6 * h, np.float32),
        "uf": normal(h**-0.5, h, 3 * h), "ub": normal(h**-0.5, h, 3 * h),
        "a": normal((2 * h) ** -0.5, 2 * h, ATTENTION), "v": normal(ATTENTION**-0.5, ATTENTION),
        "o": normal((2 * h) ** -0.5, 2 * h), "c": np.zeros(1, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _gru(x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
    """States (time, batch, hidden) for projected inputs (time, batch, 3 hidden); ``keep`` gets each step's values."""
    t, b, h3 = x.shape
    h, state = h3 // 3, np.zeros((b, h3 // 3), x.dtype)
    out = np.empty((t, b, h), x.dtype)
    if mask is None and keep is None:  # scoring: the same steps in place, a row per hidden unit
        across, state, hu = np.ascontiguousarray(u.T), np.zeros((h, b), x.dtype), np.empty((h3, b), x.dtype)
        gates, z, r, new = hu[:2 * h], hu[:h], hu[h:2 * h], hu[2 * h:]
        for k in range(t):
            given = x[k].T
            np.matmul(across, state, out=hu)
            gates += given[:2 * h]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new *= r
            new += given[2 * h:]
            np.tanh(new, out=new)
            state -= new
            state *= z
            state += new
            out[k] = state.T
        return out
    for k in range(t):
        hu = state @ u
        gates = _sigmoid(x[k, :, :2 * h] + hu[:, :2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(x[k, :, 2 * h:] + r * hu[:, 2 * h:])
        nxt = new + z * (state - new)
        if mask is not None:
            nxt = np.where(mask[k, :, None], nxt, state)
        if keep is not None:
            keep.append((state, z, r, new, hu[:, 2 * h:]))
        state = nxt
        out[k] = nxt
    return out


def _gru_back(d_out: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``u`` for the gradient of the states."""
    t, b, h = d_out.shape
    dx, du, d = np.empty((t, b, 3 * h), d_out.dtype), np.zeros_like(u), np.zeros((b, h), d_out.dtype)
    for k in range(t - 1, -1, -1):
        state, z, r, new, hn = keep[k]
        d = d + d_out[k]
        stay = 0
        if mask is not None:
            m = mask[k, :, None]
            stay, d = np.where(m, 0, d), np.where(m, d, 0)
        dn = d * (1 - z) * (1 - new * new)
        dz = d * (state - new) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        dx[k] = np.concatenate([dz, dr, dn], axis=1)
        dhu = np.concatenate([dz, dr, dn * r], axis=1)
        du += state.T @ dhu
        d = d * z + dhu @ u.T + stay
    return dx, du


def forward(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; ``x`` (time, batch, 6 hidden) are projected inputs, ``mask`` (time, batch) true at words."""
    h3 = 3 * HIDDEN
    kf, kb = ([], []) if keep is not None else (None, None)
    f = _gru(x[:, :, :h3], p["uf"], mask, kf)
    back = _gru(x[::-1, :, h3:], p["ub"], None if mask is None else mask[::-1], kb)[::-1]
    s = np.concatenate([f, back], axis=2)
    a = np.tanh(s @ p["a"])
    e = a @ p["v"]
    if mask is not None:
        e = np.where(mask, e, -1e9)
    e = np.exp(e - e.max(axis=0))
    e /= e.sum(axis=0)
    pooled = (e[:, :, None] * s).sum(axis=0)
    if keep is not None:
        keep.update(kf=kf, kb=kb, s=s, a=a, e=e, pooled=pooled)
    return pooled @ p["o"] + p["c"][0]


def backward(p: dict[str, np.ndarray], d_logit: np.ndarray, mask: np.ndarray | None, keep: dict) -> dict[str, np.ndarray]:
    """Gradients of the parameters above the inputs; ``x`` is that of the projected inputs."""
    s, a, e = keep["s"], keep["a"], keep["e"]
    g = {"o": keep["pooled"].T @ d_logit, "c": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * p["o"]
    ds = e[:, :, None] * d_pooled
    de = (s * d_pooled).sum(axis=2)
    de = e * (de - (e * de).sum(axis=0))
    da = de[:, :, None] * p["v"] * (1 - a * a)
    g["v"] = np.einsum("tb,tba->a", de, a)
    g["a"] = np.einsum("tbs,tba->sa", s, da)
    ds = ds + da @ p["a"].T
    dxf, g["uf"] = _gru_back(ds[:, :, :HIDDEN], p["uf"], mask, keep["kf"])
    dxb, g["ub"] = _gru_back(ds[::-1, :, HIDDEN:], p["ub"], None if mask is None else mask[::-1], keep["kb"])
    g["x"] = np.concatenate([dxf, dxb[::-1]], axis=2)
    return g


def window_logits(p: dict[str, np.ndarray], words: Words, starts: np.ndarray, batch: int = 1024) -> np.ndarray:
    projected = words.inputs(p) @ p["w"] + p["b"]
    length = min(WINDOW, words.n)
    at = np.arange(length)[:, None]
    return np.concatenate([forward(p, projected[at + starts[k:k + batch]], None)
                           for k in range(0, len(starts), batch)])


def document_logits(p: dict[str, np.ndarray], texts: list[str | None]) -> list[tuple[float, float, int]]:
    """Largest window logit, sum of window probabilities and number of windows per text (0 windows: no words).

    Full windows of many texts run together; a text shorter than a window is
    one window of its own length, run with others of that length.
    """
    best, total, count = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    waiting: dict[int, list] = {}
    held: dict[int, int] = {}

    def run(length: int) -> None:
        owner = np.concatenate([np.full(w.shape[1], k) for k, w in waiting[length]])
        logit = forward(p, np.concatenate([w for _, w in waiting[length]], axis=1), None)
        np.maximum.at(best, owner, logit)
        np.add.at(total, owner, _sigmoid(np.clip(logit.astype(np.float64), -30, 30)))
        waiting.pop(length)
        held.pop(length)

    for some in _grouped((k, x) for k, text in enumerate(texts) for x in pieces(text)):
        for (k, x), (projected, which) in zip(some, projected_once(p, [x for _, x in some])):
            length = min(WINDOW, len(which))
            at = np.arange(length)[:, None]
            for low in range(0, len(x.windows), 512):
                part = projected[which[at + x.windows[low:low + 512]]]
                waiting.setdefault(length, []).append((k, part))
                held[length] = held.get(length, 0) + part.shape[1]
                if held[length] >= 512:
                    run(length)
            count[k] += len(x.windows)
    for length in sorted(waiting):
        run(length)
    return list(zip(best.tolist(), total.tolist(), count.tolist()))


def _grouped(found: Iterable[tuple[int, Piece]]) -> Iterator[list[tuple[int, Piece]]]:
    """Pieces in groups of about ``TOGETHER`` words."""
    group, held = [], 0
    for k, x in found:
        group.append((k, x))
        held += len(x.starts)
        if held >= TOGETHER:
            yield group
            group, held = [], 0
    if group:
        yield group


def window_texts(text: str | None) -> Iterator[str]:
    """Every window of a text, as text."""
    codes = code_points(text)
    starts, ends = word_runs(codes)
    for w in windows(len(starts)).tolist():
        yield codes[starts[w]:ends[min(w + WINDOW, len(starts)) - 1]].tobytes().decode("utf-32-le", "surrogatepass")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``k, toxic, i, window`` from ``k, toxic, text``, some hundred windows at a time."""
    for b in batches:
        for k, toxic, text in zip(*(b.column(c).to_pylist() for c in ("k", "toxic", "text"))):
            every = enumerate(window_texts(text))
            while part := list(islice(every, 512)):
                yield pa.RecordBatch.from_pydict({
                    "k": pa.array([k] * len(part), pa.int64()), "toxic": pa.array([toxic] * len(part), pa.int32()),
                    "i": pa.array([i for i, _ in part], pa.int64()), "window": pa.array([w for _, w in part])})


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's documents of each class have each word and gram bucket (grams behind the words)."""
    seen = np.zeros((2, WORD_BUCKETS + GRAM_BUCKETS), np.int64)
    for b in batches:
        for toxic, text in zip(b.column("toxic").to_pylist(), b.column("text").to_pylist()):
            has = np.zeros(seen.shape[1], bool)
            for words, _ in word_chunks(text):
                has[words.word] = True
                for g in words.grams:
                    has[WORD_BUCKETS + g] = True
            seen[int(toxic)] += has
    y, at = np.nonzero(seen)
    yield pa.RecordBatch.from_pydict({"toxic": pa.array(y, pa.int32()), "bucket": pa.array(at, pa.int32()),
                                      "n": pa.array(seen[y, at], pa.int64())})


def log_odds(seen: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log-odds of the classes per bucket, and which buckets enough documents have."""
    n = documents + 2
    odds = np.log((seen[1] + 1) / n[1]) - np.log((seen[0] + 1) / n[0])
    both = seen.sum(axis=0)
    return (np.clip(odds, -3, 3) * both / (both + SHRINK)).astype(np.float32), (both >= LEAST_SEEN)[:, None]


class Network:
    """Parameters and their optimiser (Adam)."""

    def __init__(self, seen: np.ndarray, documents: np.ndarray, seed: int = 11):
        self.p, self.known = initial(seed), {}
        for name, part in (("words", seen[:, :WORD_BUCKETS]), ("grams", seen[:, WORD_BUCKETS:])):
            self.p[name][:, 0], self.known[name] = log_odds(part, documents)
        self.p["grams"][:, MAX_DIM] = self.p["grams"][:, 0]
        for name, rows in self.known.items():
            self.p[name] = self.p[name] * rows
        self.m1, self.m2, self.steps = {}, {}, 0

    def learn(self, texts: list[str], label: np.ndarray, weight: np.ndarray) -> None:
        """One step on a batch of windows."""
        parts = []
        for t in texts:
            codes = code_points(t)
            starts, ends = word_runs(codes)
            parts.append(Words(codes, starts[:WINDOW], ends[:WINDOW]))
        keep: dict = {}
        logit, mask, batch = _batch(self.p, parts, keep)
        d = ((_sigmoid(logit) - label) * weight / len(parts)).astype(np.float32)
        g = backward(self.p, d, mask, keep)
        g |= _input_gradients(self.p, g.pop("x"), batch, keep["inputs"])
        for name, rows in self.known.items():
            g[name] *= rows
        self.steps += 1
        for name, slope in g.items():
            self.m1[name] = 0.9 * self.m1.get(name, 0) + 0.1 * slope
            self.m2[name] = 0.99 * self.m2.get(name, 0) + 0.01 * slope * slope
            self.p[name] = (self.p[name] - RATE * (self.m1[name] / (1 - 0.9**self.steps))
                            / (np.sqrt(self.m2[name] / (1 - 0.99**self.steps)) + 1e-6)).astype(np.float32)


def train(rows: DataFrame, seed: int = 11) -> dict[str, np.ndarray] | None:
    """Fit on a stored table of a bounded number of rows (``k, toxic, text``); None without both classes."""
    spark = rows.sparkSession
    cut = stored(rows.mapInArrow(_cut, "k long, toxic int, i long, window string"), "windows")
    documents = np.zeros(2)
    for r in cut.filter("i = 0").groupBy("toxic").count().collect():
        documents[r["toxic"]] = r["count"]
    if not documents.all():
        return None
    counts = rows.mapInArrow(_document_counts, "toxic int, bucket int, n long").groupBy("toxic", "bucket").agg(
        F.sum("n").alias("n")).toArrow()  # two numbers per bucket at most
    seen = np.zeros((2, WORD_BUCKETS + GRAM_BUCKETS))
    seen[counts["toxic"].to_numpy(), counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    net = Network(seen, documents, seed)
    price = documents.sum() / (2 * documents)

    def passed(found: Iterable) -> None:
        found = iter(found)
        while part := list(islice(found, BATCH)):
            label = np.array([r["toxic"] for r in part], np.float32)
            net.learn([r["window"] for r in part], label, price[label.astype(int)])

    best: list = []
    for turn in range(ROUNDS):
        if turn < ON_ALL:
            passed(cut.orderBy(F.xxhash64("k", "i", F.lit(turn)), "k", "i").select("toxic", "window").toLocalIterator())
            continue
        if (turn - ON_ALL) % 2 == 0:
            given = spark.sparkContext.broadcast(net.p)

            def logits(texts):
                return [[m for m, _, _ in document_logits(given.value, texts)]]

            scored = per_text(cut.select("k", "i", "toxic", "window", F.col("window").alias("text")), logits, "logit double")
            best = scored.groupBy("k").agg(F.max_by(F.struct("toxic", "window"), F.struct("logit", -F.col("i"))).alias(
                "best")).orderBy("k").select("best.*").collect()  # one window a row
        r = np.random.default_rng(seed + turn)
        passed([best[i] for i in r.permutation(len(best))])
    return net.p


def _batch(p: dict[str, np.ndarray], parts: list[Words], keep: dict | None = None):
    """Logits of windows of any length, padded and masked."""
    inputs = [w.inputs(p) for w in parts]
    t = max(w.n for w in parts)
    x = np.zeros((t, len(parts), inputs[0].shape[1]), np.float32)
    mask = np.zeros((t, len(parts)), bool)
    for k, v in enumerate(inputs):
        x[:len(v), k] = v
        mask[:len(v), k] = True
    if keep is not None:
        keep["inputs"] = x
    return forward(p, x @ p["w"] + p["b"], mask, keep), mask, parts


def _input_gradients(p, dx, parts, x):
    flat = dx.reshape(-1, dx.shape[2])
    g = {"w": x.reshape(-1, x.shape[2]).T @ flat, "b": flat.sum(axis=0)}
    d = dx @ p["w"].T
    own = np.concatenate([d[:w.n, k] for k, w in enumerate(parts)])
    g["words"] = _scatter(np.concatenate([w.word for w in parts]), own[:, :WORD_DIM], WORD_BUCKETS)
    most, mean = own[:, WORD_DIM:WORD_DIM + MAX_DIM], own[:, WORD_DIM + MAX_DIM:]
    mean = mean / np.concatenate([w.counts[0] + w.counts[1] for w in parts])[:, None]
    top = np.concatenate([x[:w.n, k, WORD_DIM:WORD_DIM + MAX_DIM] for k, w in enumerate(parts)])
    at, rows = [], []
    for k in (0, 1):
        grams, n = np.concatenate([w.grams[k] for w in parts]), np.concatenate([w.counts[k] for w in parts])
        # the maximum's gradient goes to each gram that attains it
        won = p["grams"][grams, :MAX_DIM] == np.repeat(top, n, axis=0)
        at.append(grams)
        rows.append(np.concatenate([np.repeat(most, n, axis=0) * won, np.repeat(mean, n, axis=0)], axis=1))
    g["grams"] = _scatter(np.concatenate(at), np.concatenate(rows), GRAM_BUCKETS)
    return g


def _scatter(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, weights=rows[:, k], minlength=n) for k in range(rows.shape[1])],
                    axis=1).astype(np.float32)


def _document_features(logit: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    n = np.maximum(n, 1)
    return np.stack([np.ones(len(logit)), np.clip(logit, -20, 20) / 2,
                     np.log(np.clip(total / n, 1e-9, 1)) / 2, np.log(n)], axis=1)


def calibrate(f: np.ndarray, label: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights of the document features by Newton steps with a small ridge; classes weigh as they come."""
    prior = np.array([0.0, 1.0, 0.0, 0.0])
    w, hold = prior, ridge * np.diag([0.01, 1.0, 1.0, 1.0])
    for _ in range(30):
        q = _sigmoid(np.clip(f @ w, -30, 30))
        slope = f.T @ (q - label) + hold @ (w - prior)
        w = w - np.linalg.solve((f * (q * (1 - q))[:, None]).T @ f + hold, slope)
    return w


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic, text, k`` of at most ``TRAIN_ROWS`` rows per class that are not held out, in a stored table."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~is_held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("_h", F.xxhash64("doc_id"))
    picked = None
    for y in (0, 1):
        one = known.filter(F.col("toxic") == y).orderBy("_h", "doc_id").limit(TRAIN_ROWS)
        picked = one if picked is None else picked.unionByName(one)
    # 2 * TRAIN_ROWS slim rows at most: small enough to broadcast at any size of the corpus
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").orderBy("_h", "doc_id", "text").limit(
        2 * TRAIN_ROWS).select("toxic", "text")
    # dealt out again: the rows' windows are cut and scored by many tasks
    return stored(stored(found, "training").withColumn("k", F.monotonically_increasing_id()).repartition(
        64, "k"), "training-dealt")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, np.ndarray], np.ndarray] | None:
    ship(docs.sparkSession)
    rows = training_rows(docs, labels)
    apart = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    p = train(rows.filter(~apart).select("k", "toxic", "text"))
    if p is None:
        return None
    given = docs.sparkSession.sparkContext.broadcast(p)

    def run(texts):
        return list(zip(*document_logits(given.value, texts)))

    scored = np.array([(r["m"], r["t"], r["n"], r["toxic"]) for r in per_text(
        rows.filter(apart), run, "m double, t double, n long").filter("n > 0").toLocalIterator()]).reshape(-1, 4)
    return p, calibrate(_document_features(*scored[:, :3].T), scored[:, 3])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_windows`` per document."""
    model = fit(docs, labels)
    given = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the corpus

    def run(texts):
        if given.value is None:
            return [[0.0] * len(texts), [0] * len(texts)]
        p, w = given.value
        m, total, n = (np.array(x) for x in zip(*document_logits(p, texts)))
        score = _sigmoid(np.clip(_document_features(np.where(n > 0, m, 0), total, n) @ w, -30, 30))
        return [np.where(n > 0, score, 0.0), n]

    out = per_text(docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text"), run,
                   "score double, n_windows long")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      "n_windows")
