"""Operator 1: benchmark decontamination by latent semantic retrieval.

Passages: a document's words in windows.  Words fall into ``VOCAB`` hashed
terms, so everything that is fitted has a bounded size whatever the vocabulary.

1. One pass over all passages of all documents counts in how many each term is;
   that gives the weights (square root of the inverse document frequency: at
   full strength the rarest words decide alone, and paraphrases replace those).
2. Randomised SVD of the TF-IDF passages in Spark tasks: all passages of all
   documents and all benchmark items.  The matrix meets a random block and a power
   iteration, a pass over the stored passages each; the products are summed by
   term.  The space's axes are scaled to equal spread
   (divided by their singular values, at most ``MOST_SPREAD`` times the median),
   so that the few axes of very common words do not decide how close two passages
   are, and passages that much of the corpus shares still count.
3. Every passage of every document is folded into the space and compared with
   every item by cosine.  Items are grouped by length; a group's window holds at
   least 4/3 of its longest item and moves by a quarter of its size, so some
   window contains each copy whole.  ``LEAST_COSINE`` is the only way into the
   next step.
4. Candidates pass the longest common subsequence of words with the item, and
   the answer check: the item's last sentence, or its last words, must be
   there too, in order.  So paraphrases that change words are caught, and
   passages that only share a topic are not.

The benchmark is read in blocks of at most ``BLOCK_ITEMS`` items, one pass over
the documents for each; what is broadcast is the space and a block's vectors.

Defined cases: null and empty texts contaminate nothing; items without words
are skipped; a repeated item or document matches each time; rows that repeat an
id are matched one by one and reported once per (doc_id, item_id) with the best
match; extra columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.store import per_text, ship, stored
from finlake.llm.text import code_points, hashes_of_words, word_hashes, word_runs

#: hashed terms, axes of the latent space
VOCAB, RANK = 1 << 14, 256
OVERSAMPLE = 16
POWER_ROUNDS = 1
MOST_SPREAD = 4.0
#: words of a passage that counts and the fit take
PASSAGE = 64
#: passages multiplied at a time; rows of a sum taken together; terms whose sums a task adds; passages of a task of
#: the fit, and the fewest tasks
ROWS, SEGMENT, PART = 1 << 14, 32, 64
TASK_ROWS, LEAST_TASKS = 1 << 18, 6
#: least cosine of a passage and an item in the latent space
LEAST_COSINE = 0.25
#: longest common subsequence over item length, and the same for the answer
LEAST_LCS = 0.6
LEAST_ANSWER = 0.5
#: words of the answer where the last sentence is shorter or is the whole item
ANSWER_WORDS = 5
#: items in a block: 16 MB of vectors
BLOCK_ITEMS = 1 << 14
#: words of the smallest window
SMALLEST = 8
#: words folded at a time, texts or pieces of a text; of these so many in a gather that stays in cache; cosines held
CHUNK, GATHER, HELD = 1 << 14, 1 << 9, 1 << 21
#: passages whose words are looked up together, and lookups at a time
ROOMS, LOOKED = 32, 1 << 16


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words (runs of letters and digits, lower-cased)."""
    codes = code_points(text)
    return word_hashes(codes, *word_runs(codes))


class Item(NamedTuple):
    item_id: int | None
    words: np.ndarray
    answer: np.ndarray


def make_item(item_id: int | None, text: str | None) -> Item:
    """The item's words and its answer: the last sentence, at least ``ANSWER_WORDS`` words."""
    words = words_of(text)
    sentences = [x for x in re.split(r"[.!?]+", text or "") if len(words_of(x))]
    last = len(words_of(sentences[-1])) if len(sentences) > 1 else 0
    return Item(item_id, words, words[-max(last, ANSWER_WORDS):])


def window_size(n: int) -> int:
    """The power of two that holds 4/3 of ``n`` words, so that windows a quarter apart hold it whole."""
    size = SMALLEST
    while 3 * size < 4 * n:
        size *= 2
    return size


def blocks(items: Iterable[Item]) -> Iterator[list[Item]]:
    """The items with words, in order, in blocks of bounded size."""
    some = (it for it in items if len(it.words))
    while block := list(islice(some, BLOCK_ITEMS)):
        yield block


def hashed(words: np.ndarray) -> np.ndarray:
    """The term of each word."""
    return (words >> np.uint64(20) & np.uint64(VOCAB - 1)).astype(np.int32)  # a power of two


def passage_rows(texts: DataFrame, whole: bool = False) -> DataFrame:
    """``terms binary, values binary``: each passage's terms in order (16 bits each) and how often it has them (float).

    A text's words are cut into passages of ``PASSAGE``, or are one passage if ``whole``.
    """
    def run(batches):
        for b in batches:
            for low in range(0, b.num_rows, 64):
                terms = [hashed(w) for w in hashes_of_words(b.column("text").slice(low, 64).to_pylist())]
                for t in _few(terms):
                    n = np.array([len(x) for x in t])
                    if not n.sum():
                        continue
                    each = -(-CHUNK // PASSAGE)  # passages of a chunk
                    cuts = (n > 0).astype(np.int64) if whole else n // CHUNK * each - (-(n % CHUNK) // PASSAGE)
                    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    passage = np.repeat(np.cumsum(cuts) - cuts, n) + (
                        0 if whole else place // CHUNK * each + place % CHUNK // PASSAGE)
                    key, often = np.unique(passage * VOCAB + np.concatenate(t), return_counts=True)
                    ends = np.append(0, np.cumsum(np.bincount(key // VOCAB)))
                    yield pa.RecordBatch.from_arrays(
                        [_packed((key % VOCAB).astype(np.uint16), ends), _packed(often.astype(np.float32), ends)],
                        names=["terms", "values"])

    ship(texts.sparkSession)
    return texts.select("text").mapInArrow(run, "terms binary, values binary")


def _packed(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of numbers as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1,
                                 [None, pa.py_buffer((ends * numbers.itemsize).astype(np.int32)), pa.py_buffer(numbers)])


def _numbers(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, packed or in arrays, and how many each row has."""
    if not pa.types.is_binary(column.type):
        return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]] if len(column) else np.zeros(0, np.uint8)
    return flat.view(dtype), np.diff(ends) // np.dtype(dtype).itemsize


def _few(terms: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Texts in groups of about ``CHUNK`` words."""
    group, held = [], 0
    for t in terms:
        group.append(t)
        held += len(t)
        if held >= CHUNK:
            yield group
            group, held = [], 0
    if group:
        yield group


def passage_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many passages hold each term, and how many passages there are, over all documents."""
    return row_counts(passage_rows(docs))


def row_counts(passages: DataFrame) -> tuple[np.ndarray, int]:
    """How many rows of :func:`passage_rows` hold each term, and how many rows there are."""
    def run(batches):
        df, n = np.zeros(VOCAB, np.int64), 0
        for b in batches:
            n += b.num_rows
            df += np.bincount(_numbers(b.column("terms"), np.uint16)[0], minlength=VOCAB)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))],
                                         names=["term", "n"])

    rows = passages.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")).toArrow()  # a row per term
    out, term, n = np.zeros(VOCAB, np.int64), rows.column("term").to_numpy(), rows.column("n").to_numpy()
    out[term[term >= 0]] = n[term >= 0]
    return out, int(n[term < 0].sum())


def term_weights(df: np.ndarray, n: int) -> np.ndarray:
    """Square roots of the smoothed inverse document frequencies; a word that is everywhere still weighs one."""
    return np.sqrt(np.log((n + 1) / (df + 1)) + 1).astype(np.float32)


def spread_axes(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Left singular vectors (zero where there is none) and values of a tall matrix, from its small Gram matrix.

    The matrix is held twice and nothing else of its size.
    """
    gram = np.zeros((block.shape[1], block.shape[1]))
    for low in range(0, len(block), 1024):
        part = block[low:low + 1024].astype(np.float64)
        gram += part.T @ part
    w, v = np.linalg.eigh(gram)
    s = np.sqrt(np.maximum(w[::-1], 0))
    s = np.where(s > 1e-5 * max(float(s[0]), 1e-30), s, 0)
    return block @ (v[:, ::-1] / np.where(s > 0, s, np.inf)).astype(np.float32), s


def summed_rows(table: np.ndarray, at: np.ndarray, values: np.ndarray, into: np.ndarray,
                fold: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Per number of ``into`` (ascending) the sum of ``values * table[at]``: the numbers, their sums.

    Sums are taken over ``SEGMENT`` rows at a time, then added up; ``fold`` of them at once, where most numbers have so many.
    """
    first = np.flatnonzero(np.diff(into, prepend=-1))
    size = np.diff(np.append(first, len(into)))
    segments = -(-size // (fold * SEGMENT))
    begin = np.cumsum(segments) - segments
    n, width = int(segments.sum()), table.shape[1]
    place = np.repeat(begin * (fold * SEGMENT) - first, size)
    place += np.arange(len(into))
    ids, v = np.zeros(n * fold * SEGMENT, np.intp), np.zeros(n * fold * SEGMENT, np.float32)
    ids[place], v[place] = at, values
    v = v.reshape(n, fold, 1, SEGMENT)
    step = max(1, GATHER // (fold * SEGMENT))
    held = np.empty((step * fold * SEGMENT, width), np.float32)
    some, parts = np.empty((step, fold, 1, width), np.float32), np.empty((n, 1, width), np.float32)
    for k in range(0, n, step):
        m = min(step, n - k)
        rows = held[:m * fold * SEGMENT]
        np.take(table, ids[k * fold * SEGMENT:(k + m) * fold * SEGMENT], axis=0, out=rows, mode="clip")
        sums = parts[k:k + m, None] if fold == 1 else some[:m]
        np.matmul(v[k:k + m], rows.reshape(m, fold, SEGMENT, width), out=sums)
        if fold > 1:
            np.add(sums[:, 0], sums[:, 1], out=parts[k:k + m])
        for j in range(2, fold):
            parts[k:k + m] += sums[:, j]
    if n == len(first):
        return into[first], parts[:, 0]
    out = parts[begin, 0]
    more = np.flatnonzero(segments > 1)
    for k in range(1, int(segments.max(initial=0))):
        more = more[segments[more] > k]
        out[more] += parts[begin[more] + k, 0]
    return into[first], out


class Rows(NamedTuple):
    """Rows of a sparse matrix: term, value and row number of each entry, and how many rows there are."""

    term: np.ndarray
    value: np.ndarray
    row: np.ndarray
    n: int


def matrix_rows(batch: list[pa.RecordBatch], weight: np.ndarray | None) -> Rows:
    """The batches' rows; with ``weight`` (of a term) weighted and brought to length one."""
    parts = [(*_numbers(b.column("terms"), np.uint16), _numbers(b.column("values"), np.float32)[0]) for b in batch]
    t, size, v = (np.concatenate(x) for x in zip(*parts))
    t, v, row = t.astype(np.intp), v.astype(np.float32), np.repeat(np.arange(len(size)), size)
    if weight is not None:
        v = v * weight[t]
        v /= np.maximum(np.sqrt(np.bincount(row, v * v, len(size))), 1e-12).astype(np.float32)[row]
    return Rows(t, v, row, len(size))


def add_product(rows: Rows, y: np.ndarray, out: np.ndarray) -> None:
    """Add A'(A y) to ``out``."""
    if not len(rows.term):
        return
    at, z = summed_rows(y, rows.term, rows.value, rows.row, PASSAGE // SEGMENT)
    if len(at) < rows.n:
        some, z = z, np.zeros((rows.n, y.shape[1]), np.float32)
        z[at] = some
    at, sums = summed_rows(z, *by_term(rows, len(y)))
    out[at] += sums


def by_term(rows: Rows, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, value and term of each entry in the order of terms, then of rows."""
    if max(n_terms, rows.n) > 1 << 16:
        order = np.argsort(rows.term, kind="stable")
        return rows.row[order], rows.value[order], rows.term[order]
    # term, row and value in one number: sorted as such, no index is followed
    key = rows.term.astype(np.uint64) << np.uint64(16) | rows.row.astype(np.uint64)
    key = key << np.uint64(32) | rows.value.view(np.uint32)
    key.sort()
    return ((key >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.intp), key.astype(np.uint32).view(np.float32),
            (key >> np.uint64(48)).astype(np.intp))


def randomised_svd(rows: DataFrame, n_terms: int, rank: int = RANK, seed: int = 3,
                   weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal basis (terms x rank) of the leading row space of a sparse matrix, and the singular values.

    ``rows``: one row per passage, ``terms`` in order and their ``values``, as arrays or as of :func:`passage_rows`;
    with ``weight`` (of a term) the rows are weighted and brought to length one.
    Each task multiplies its rows, A'(A Y), and the products are summed by term;
    the driver orthonormalises the sum, terms x (rank + oversampling).
    """
    spark = rows.sparkSession
    ship(spark)
    width = min(rank + OVERSAMPLE, n_terms)

    def start() -> np.ndarray:
        return np.random.default_rng(seed).standard_normal((n_terms, width)).astype(np.float32)

    block, given = None, None
    for _ in range(1 + POWER_ROUNDS):
        if block is not None:  # half precision is enough for directions; the sums are not rounded
            given = spark.sparkContext.broadcast(spread_axes(block)[0].astype(np.float16))
            block = None

        def run(batches, given=given):
            y = start() if given is None else given.value.astype(np.float32)
            out, held, n = np.zeros_like(y), [], 0
            for b in batches:
                held.append(b)
                n += b.num_rows
                if n >= ROWS:
                    add_product(matrix_rows(held, weight), y, out)
                    held, n = [], 0
            if held:
                add_product(matrix_rows(held, weight), y, out)
            at = np.flatnonzero(out.any(axis=1))
            for low in range(0, len(at), 1024):
                part = at[low:low + 1024]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([x.tobytes() for x in out[part]])],
                                                 names=["term", "v"])

        def summed(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low = key[0].as_py() * PART
            out, seen = np.zeros((PART, width), np.float32), np.zeros(PART, bool)
            for b in parts:
                at = b.column("term").to_numpy() - low
                seen[at] = True
                for k, x in zip(at.tolist(), _numbers(b.column("v"), np.float32)[0].reshape(-1, width)):
                    out[k] += x
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(at + low), pa.array([x.tobytes() for x in out[at]])],
                                             names=["term", "v"])

        found = rows.mapInArrow(run, "term long, v binary").groupBy(
            F.expr(f"term div {PART}").alias("part")).applyInArrow(summed, "term long, v binary").toArrow()
        block = np.zeros((n_terms, width), np.float32)
        for b in found.to_batches():
            block[b.column("term").to_numpy()] = _numbers(b.column("v"), np.float32)[0].reshape(-1, width)
        del found
        if given is not None:
            given.destroy()
    u, s = spread_axes(block)
    del block
    held = s[:rank] > 0
    return u[:, :rank][:, held], np.sqrt(s[:rank][held])


class Space:
    """The latent space: one row per term (the last one, of padding, is zero), weight and scaling included.

    It travels in half precision, 8 MB, and is rounded to it from the start, so the driver and the tasks agree.
    """

    def __init__(self, table: np.ndarray):
        self.table = table.astype(np.float16).astype(np.float32)

    def __getstate__(self) -> dict:
        return {"table": self.table.astype(np.float16)}

    def __setstate__(self, state: dict) -> None:
        self.table = state["table"].astype(np.float32)

    def fold(self, terms: np.ndarray) -> np.ndarray:
        return self.table[terms].sum(axis=0)


def fit(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> Space:
    """The space of all passages of all documents and of the benchmark's items."""
    passages = stored(passage_rows(docs), "fit-passages")
    df, n = row_counts(passages)
    weight = term_weights(df, n)
    # each task sends a sum of up to VOCAB rows, so there are few, in proportion to the passages
    rows = passages.unionByName(passage_rows(benchmark, whole=True)).coalesce(max(LEAST_TASKS, n // TASK_ROWS))
    basis, s = randomised_svd(rows, VOCAB, rank, weight=weight)
    spread = np.minimum(s, MOST_SPREAD * np.median(s)) if len(s) else s
    table = np.zeros((VOCAB + 1, len(s)), np.float16)  # made in parts: the driver has little room
    for low in range(0, VOCAB, 1024):
        part = slice(low, low + 1024)
        table[:-1][part] = basis[part] * (weight[part, None] / spread[None, :])
    return Space(table)


class Block(NamedTuple):
    """A block of items, their words as sets and as terms (padded, with their number), their unit vectors by window size."""

    items: list[Item]
    sets: list[frozenset]
    terms: np.ndarray
    lengths: np.ndarray
    vectors: dict[int, tuple[np.ndarray, np.ndarray]]


def make_block(items: list[Item], space: Space) -> Block:
    z = np.stack([space.fold(hashed(it.words)) for it in items])
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    sizes = np.array([window_size(len(it.words)) for it in items])
    lengths = np.array([len(it.words) for it in items])
    terms = np.full((len(items), lengths.max()), VOCAB, np.int32)
    for k, it in enumerate(items):
        terms[k, :lengths[k]] = hashed(it.words)
    return Block(items, [frozenset(it.words.tolist()) for it in items], terms, lengths, {size: (np.flatnonzero(sizes == size), np.ascontiguousarray(z[sizes == size].T))
                         for size in np.unique(sizes).tolist()})


def lcs(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """Length of the longest common subsequence, and the first and last place in ``b`` where it grows.

    Bit-parallel: one integer of ``len(a)`` bits per step of ``b``.
    """
    place: dict[int, int] = {}
    for i, x in enumerate(a):
        place[x] = place.get(x, 0) | 1 << i
    row, full, first, last, best = 0, (1 << len(a)) - 1, -1, -1, 0
    for j, x in enumerate(b):
        hit = place.get(x)
        if hit is None:
            continue
        grown = row | hit
        row = grown & ~(grown - ((row << 1) | 1)) & full
        n = row.bit_count()
        if n > best:
            best, last = n, j
            first = j if first < 0 else first
    return best, first, last


class Piece(NamedTuple):
    """Words ``low`` to ``high`` of a text; the windows that begin before ``until`` are looked at here."""

    text: int
    low: int
    high: int
    until: int


def pieces(lengths: list[int], largest: int) -> Iterator[list[Piece]]:
    """Batches of pieces of about ``CHUNK`` words; a long text's pieces overlap by a window."""
    chunk = max(CHUNK // largest, 1) * largest
    batch, held = [], 0
    for k, n in enumerate(lengths):
        for low in range(0, n, chunk):
            high = min(n, low + chunk + largest)
            batch.append(Piece(k, low, high, low + chunk))
            held += high - low
            if held >= CHUNK:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


class Close(NamedTuple):
    """Passages and items that are close in the space, all of one window size: text, window, item, cosine."""

    size: int
    text: np.ndarray
    window: np.ndarray
    item: np.ndarray
    cosine: np.ndarray


def added_up(table: np.ndarray, ids: np.ndarray, base: int) -> np.ndarray:
    """The sums of ``base`` rows of the table in a row."""
    step, one = max(GATHER // base, 1) * base, np.ones((1, base), np.float32)
    held, out = np.empty((step, table.shape[1]), np.float32), np.empty((len(ids) // base, 1, table.shape[1]), np.float32)
    for k in range(0, len(ids), step):
        rows = held[:len(ids[k:k + step])]
        np.take(table, ids[k:k + step], axis=0, out=rows, mode="clip")
        np.matmul(one, rows.reshape(-1, base, table.shape[1]), out=out[k // base:(k + step) // base])
    return out[:, 0]


def candidates(texts: list[np.ndarray], space: Space, block: Block,
               terms: list[np.ndarray] | None = None) -> Iterator[Close]:
    """Every passage and item that are close in the space.

    Many texts are folded together: sums over quarters of the smallest window,
    added up to those of the next size; a window is four quarters in a row.
    """
    if not block.vectors:
        return
    base, unit, width = min(block.vectors) // 4, max(block.vectors) // 4, space.table.shape[1]
    terms = terms or [hashed(w) for w in texts]
    for batch in pieces([len(w) for w in texts], max(block.vectors)):
        parts, starts, at = [], [], 0
        for p in batch:  # pieces begin at a quarter of every size
            n = p.high - p.low
            parts += [terms[p.text][p.low:p.high], np.full(-n % unit, VOCAB, np.int32)]
            starts.append(at)
            at += n + -n % unit
        ids, starts, move = np.concatenate(parts), np.array(starts), base
        sums = added_up(space.table, ids, base)
        for size, (numbers, vectors) in sorted(block.vectors.items()):
            if size // 4 > move:
                sums = sums.reshape(-1, size // 4 // move, width).sum(axis=1)
                move = size // 4
            yield from _close(sums, starts // move, batch, texts, size, numbers, vectors)


def _close(sums: np.ndarray, starts: np.ndarray, batch: list[Piece], texts: list[np.ndarray], size: int,
           numbers: np.ndarray, vectors: np.ndarray) -> Iterator[Close]:
    """The close windows of one size; ``sums``: a row per quarter of a window, ``starts``: each piece's first."""
    move = size // 4
    z, two = sums.copy(), sums[:-1] + sums[1:]
    np.add(two[:-2], two[2:], out=z[:max(len(z) - 3, 0)])
    owner, first = np.full(len(sums), -1), np.zeros(len(sums), np.int64)
    for at, p in zip(starts.tolist(), batch):
        quarters = -(-(p.high - p.low) // move)
        n = len(texts[p.text])
        every = max(1, -(-(n - size) // move) + 1)  # windows of the whole text
        low = p.low // move
        high = max(low, min(every, -(-p.until // move)))
        owner[at:at + high - low] = p.text
        first[at:at + high - low] = np.arange(low, high)
        if quarters < 4:  # a text shorter than a window is one window
            z[at] = sums[at:at + quarters].sum(axis=0)
    rows = max(1, HELD // len(numbers))
    for k in range(0, len(z), rows):
        part = z[k:k + rows]
        norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", part, part)), 1e-12)
        cosine = part @ vectors
        w, item = np.divmod(np.flatnonzero(cosine >= LEAST_COSINE * norm[:, None]), len(numbers))
        real = owner[k + w] >= 0
        w, item = w[real], item[real]
        if len(w):
            yield Close(size, owner[k + w], first[k + w], numbers[item], cosine[w, item] / norm[w])


def with_room(found: Close, terms: list[np.ndarray], block: Block) -> Close:
    """Those whose text, and then whose passage, has enough of the item's words at all: no common subsequence has more.

    A passage has a quarter more on both sides here.  Looked up by term, so a text or passage may only seem to have more
    words than it has.
    """
    wide = block.terms[:, :block.lengths[found.item].max(initial=1)].astype(np.intp)
    one, least = np.ones(wide.shape[1], np.float32), LEAST_LCS * block.lengths
    row = VOCAB + 2  # of the padding of items, which nothing has, and of passages, which nothing asks for
    edges = np.flatnonzero(np.diff(found.text, prepend=-1))
    texts, sizes = found.text[edges].tolist(), np.diff(np.append(edges, len(found.text)))
    text = np.repeat(np.arange(len(texts)), sizes)
    words = np.concatenate([np.zeros(0, np.int32), *[terms[k] for k in texts]])
    ends = np.cumsum([0, *[len(terms[k]) for k in texts]])

    def enough(has: np.ndarray, number: np.ndarray, item: np.ndarray) -> np.ndarray:
        out, step = np.zeros(len(item), bool), max(1, LOOKED // wide.shape[1])
        for k in range(0, len(item), step):
            at = wide[item[k:k + step]]
            at += (number[k:k + step] * row)[:, None]
            out[k:k + step] = has.take(at, mode="clip").astype(np.float32) @ one >= least[item[k:k + step]]
        return out

    room, has = np.zeros((len(texts), len(block.items)), bool), np.zeros(len(texts) * row, bool)
    has[words + np.repeat(np.arange(len(texts)) * row, np.diff(ends))] = True
    room[text, found.item] = True
    number, item = np.nonzero(room)
    room[number, item] = enough(has, number, item)
    some = np.flatnonzero(room[text, found.item])

    text, window, item = text[some], found.window[some], found.item[some]
    move = found.size // 4
    edges = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(window, prepend=-1) != 0))
    number = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(some))))
    low = ends[text[edges]] + np.maximum(window[edges] - 1, 0) * move
    high = np.minimum(ends[text[edges]] + (window[edges] + 5) * move, ends[text[edges] + 1])
    edges, keep, has = np.append(edges, len(some)), np.zeros(len(some), bool), np.zeros(ROOMS * row, bool)
    for k in range(0, len(low), ROOMS):
        at = low[k:k + ROOMS, None] + np.arange(6 * move)
        own = np.where(at < high[k:k + ROOMS, None], words.take(at, mode="clip"), VOCAB + 1)
        own = own + np.arange(len(own))[:, None] * row
        has[own] = True
        part = slice(edges[k], edges[k + len(own)])
        keep[part] = enough(has, number[part] - k, item[part])
        has[own] = False
    keep = some[keep]
    return Close(found.size, *[x[keep] for x in found[1:]])


def search(texts: list[str | None], space: Space, block: Block) -> list[list[tuple[int, float, float, float, int, int]]]:
    """Per text (item number, cosine, lcs share, answer share, first word, last word) of each match."""
    words = hashes_of_words(texts)
    terms = [hashed(w) for w in words]
    best: list[dict[int, tuple]] = [{} for _ in texts]
    near: list = []
    held: set = set()
    seen: tuple = ()
    passages = (x for found in candidates(words, space, block, terms)
                for close in [with_room(found, terms, block)]
                for x in zip(*[v.tolist() for v in close[1:]], [close.size] * len(close.text)))
    for text, w, k, cosine, size in passages:
        move, item = size // 4, block.items[k]
        own, n = block.sets[k], len(item.words)
        begin = max(0, w * move - move)
        if seen != (text, size, w):
            seen, near = (text, size, w), words[text][begin:w * move + size + move].tolist()
            held = set(near)
        # a common subsequence has no more words than the passage holds of the item's
        if n - len(own) + len(own & held) < LEAST_LCS * n:
            continue
        n_common, first, last = lcs(item.words.tolist(), near)
        common = n_common / n
        if common < LEAST_LCS:
            continue
        answer = lcs(item.answer.tolist(), near)[0] / len(item.answer)
        if answer < LEAST_ANSWER:
            continue
        if k not in best[text] or (common, answer) > best[text][k][1:3]:
            best[text][k] = (cosine, common, answer, begin + first, begin + last)
    return [[(k, *v) for k, v in sorted(found.items())] for found in best]


def _prepared(docs: DataFrame, benchmark: DataFrame, rank: int) -> Iterator[tuple[Space, Block]]:
    """The benchmark is the stated query set: the driver reads its texts in order, a block at a time."""
    rows = benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    space = None
    for part in blocks(make_item(r["item_id"], r["text"]) for r in rows):
        space = space or fit(docs, benchmark, rank)
        if space.table.shape[1]:
            yield space, make_block(part, space)


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """One row per document and item it contains: ``doc_id, item_id, cosine, lcs, answer, first_word, last_word``."""
    spark = docs.sparkSession
    schema = ("hits array<struct<item_id:bigint,cosine:double,lcs:double,answer:double,first_word:bigint,"
              "last_word:bigint>>")
    out = spark.createDataFrame([], f"doc_id long, {schema}").select("doc_id", F.explode("hits").alias("h"))
    for space, block in _prepared(docs, benchmark, rank):
        given = spark.sparkContext.broadcast((space, block))

        def run(texts, given=given):
            items = given.value[1].items
            return [[[(items[k].item_id, *v) for k, *v in found] for found in search(texts, *given.value)]]

        hits = per_text(docs.select("doc_id", "text"), run, schema)
        out = out.unionByName(hits.select("doc_id", F.explode("hits").alias("h")))
    best = out.groupBy("doc_id", "h.item_id").agg(
        F.max(F.struct("h.lcs", "h.answer", "h.cosine", "h.first_word", "h.last_word")).alias("m"))
    return best.select("doc_id", "item_id", "m.cosine", "m.lcs", "m.answer", "m.first_word", "m.last_word")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; nothing is shuffled."""
    out = docs.select("text", F.struct("*").alias("row"))
    for space, block in _prepared(docs, benchmark, rank):
        given = docs.sparkSession.sparkContext.broadcast((space, block))

        def run(texts, given=given):
            return [[not found for found in search(texts, *given.value)]]

        out = per_text(out, run, "clean boolean").filter("clean").select(F.col("row.text").alias("text"), "row")
    return out.select("row.*")
