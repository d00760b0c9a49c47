"""Benchmark decontamination with suffix arrays over the training text.

Every task turns its documents, some megabytes at a time (a shard), into a
word-level suffix array: the positions of the shard sorted by the words that
follow. All test suffixes (every word position of every benchmark item that
begins a window) are binary-searched in it at once, one word depth after the
other; what is left of the range after ``window`` words are exactly the places
where that window stands verbatim. Positions whose first two words begin no
window can't match and stay out of the array, which loses nothing.

Documents never leave their task: no shuffle of texts, no pair of document and item is
expanded. The test side goes to the tasks as a broadcast of ``BLOCK_BYTES`` of
benchmark text at most; a larger benchmark is cut into blocks of items, each a job of its own with a
broadcast of its own, one after the other; their marks are merged by document row.

Words: maximal runs of ASCII letters (lower-cased), digits and non-ASCII
characters, compared by a 64-bit hash for each word.

Defined results: a null or empty text has no words, hits or items and is clean.
An item without words has no window; one of fewer words than ``window`` is a
single window. Items that share an id count once; an item without id counts
under the id ''. Repeated documents get the same result each. Empty tables give
empty results or clean documents. Further columns pass through untouched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm import textvec as V
from starmart.llm.common import keep, mapped

WINDOW = 10
BLOCK_BYTES = 32 << 20  # benchmark text in one broadcast
_HITS, _ITEMS, _WORDS, _ROW = "__hits", "__items", "__n_words", "__row"


class TestSuffixes:
    """Distinct windows of a block of benchmark items, by window length."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        owners: dict[int, dict[tuple, set[str]]] = defaultdict(lambda: defaultdict(set))
        for i, j, w in V.each_chunk(pa.array(texts, pa.large_string())):
            for d in range(i, j):
                h = w.hash[w.first[d - i] : w.first[d - i + 1]]
                n = min(window, len(h))
                for s in range(len(h) - n + 1 if n else 0):
                    owners[n][tuple(h[s : s + n].tolist())].add(ids[d])
        self.classes = []
        for n, found in sorted(owners.items()):
            keys = sorted(found)
            rows = np.array(keys, dtype=np.uint64).reshape(len(keys), n)
            self.classes.append((n, rows, [sorted(found[k]) for k in keys]))
        self.starts = _Seen(np.concatenate([_lead(r) for n, r, _ in self.classes if n > 1] or [np.zeros(0, np.uint64)]))
        self.single = _Seen(np.concatenate([V.mix(r[:, 0]) for n, r, _ in self.classes if n == 1] or [np.zeros(0, np.uint64)]))


def _lead(rows: np.ndarray) -> np.ndarray:
    return V.mix(rows[:, 0] * V.POS[0] + rows[:, 1] * V.POS[1])


class _Seen:
    """Bit table: never misses a member; a stranger that slips in only lengthens the suffix array."""

    def __init__(self, values: np.ndarray):
        self.any = len(values) > 0
        bits = max(16, int(len(values)).bit_length() + 7)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[values >> self.shift] = True

    def __call__(self, values: np.ndarray) -> np.ndarray:
        return self.table[values >> self.shift]


def suffix_array(words: V.Words, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """(positions, their next words as columns by depth), sorted by these words.

    A suffix ends with its document; past the end stands 0.
    """
    h, n = words.hash, len(words.hash)
    take = np.zeros(n, dtype=bool)
    if n > 1 and tests.starts.any:
        take[:-1] = tests.starts(V.mix(h[:-1] * V.POS[0] + h[1:] * V.POS[1]))
    if n and tests.single.any:
        take |= tests.single(V.mix(h))
    at = np.flatnonzero(take)
    depth = max((c[0] for c in tests.classes), default=0)
    stop = words.first[np.searchsorted(words.first, at, side="right")]
    cols = np.zeros((depth, len(at)), dtype=np.uint64)
    for d in range(depth):
        inside = at + d < stop
        cols[d, inside] = h[at[inside] + d]
    order = np.lexsort(cols[::-1]) if depth else np.zeros(0, np.int64)
    return at[order], cols[:, order]


def search(cols: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [lo, hi) of the suffix array that begin with each row, by simultaneous binary search."""
    lo = np.zeros(len(rows), dtype=np.int64)
    hi = np.full(len(rows), cols.shape[1], dtype=np.int64)
    for d in range(rows.shape[1]):
        q, col = rows[:, d], cols[d]
        live = np.flatnonzero(lo < hi)
        if not len(live):
            break
        for upper in (False, True):
            a, b, want = lo[live].copy(), hi[live].copy(), q[live]
            while True:
                open_ = a < b
                if not open_.any():
                    break
                mid = (a + b) >> 1
                v = col[np.minimum(mid, len(col) - 1)]
                right = open_ & ((v <= want) if upper else (v < want))
                a = np.where(right, mid + 1, a)
                b = np.where(open_ & ~right, mid, b)
            if upper:
                hi[live] = a
            else:
                low = a
        lo[live] = low
    return lo, np.maximum(lo, hi)


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(range index, position) for all positions of the ranges."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def shard_matches(words: V.Words, tests: TestSuffixes) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Of one shard: hit flag for each word; item ids by document."""
    diff = np.zeros(len(words.hash) + 1, dtype=np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    at, cols = suffix_array(words, tests)
    if len(at):
        for n, rows, owners in tests.classes:
            lo, hi = search(cols, rows)
            some = np.flatnonzero(lo < hi)
            which, k = _expand(lo[some], hi[some])
            p = at[k]
            np.add.at(diff, p, 1)
            np.add.at(diff, p + n, -1)
            doc = np.searchsorted(words.first, p, side="right") - 1
            # each document and window once
            pair = np.unique(doc * np.int64(len(rows)) + some[which])
            for d, r in zip((pair // len(rows)).tolist(), (pair % len(rows)).tolist()):
                items[d].update(owners[r])
    return np.cumsum(diff)[:-1] > 0, items


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> tuple[int, Iterator[TestSuffixes]]:
    """The benchmark as test suffixes: the number of blocks of at most about ``BLOCK_BYTES`` of text, and each in turn."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).head()["n"]
    count = 1 + int(size) // BLOCK_BYTES

    def each() -> Iterator[TestSuffixes]:
        for b in range(count):
            part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == b)
            got = part.collect()  # a block
            yield TestSuffixes([r["i"] for r in got], [r["t"] for r in got], window)

    return count, each()


def _marked(sent, text_col: str, only_hit: bool):
    """Task that adds hit positions, items and the number of words to its rows (with ``only_hit``, in place of the text, and
    rows without a hit go)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = sent.value
        for batch in batches:
            hits: list = [()] * batch.num_rows
            items: list = [()] * batch.num_rows
            n_words = np.zeros(batch.num_rows, dtype=np.int64)
            for i, j, w in V.each_chunk(batch[text_col]):
                n_words[i:j] = np.diff(w.first)
                hit, found = shard_matches(w, tests)
                for d, ids in found.items():
                    f, e = w.first[d], w.first[d + 1]
                    hits[i + d] = np.flatnonzero(hit[f:e]).astype(np.int32)
                    items[i + d] = sorted(ids)
            own = [(n, batch[n]) for n in batch.schema.names if not (only_hit and n == text_col)]
            new = [(_HITS, pa.array(hits, pa.list_(pa.int32()))), (_ITEMS, pa.array(items, pa.list_(pa.string()))), (_WORDS, pa.array(n_words))]
            out = pa.RecordBatch.from_arrays([c for _, c in own + new], names=[n for n, _ in own + new])
            if only_hit:
                out = out.filter(pa.array([len(x) > 0 for x in items], pa.bool_()))
            yield out

    return task


_ADDED = [T.StructField(_HITS, T.ArrayType(T.IntegerType())), T.StructField(_ITEMS, T.ArrayType(T.StringType())), T.StructField(_WORDS, T.LongType())]


def mark(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``documents`` with __n_words (long), __hits (array of hit word positions) and __items
    (array of item ids as strings); everything else passes through.

    A benchmark of one block is a single pass. Of a larger one, each block is a job of its own over the numbered
    texts that writes its marks (hit documents only); the driver and the tasks hold one block at a time."""
    documents = documents.drop(_HITS, _ITEMS, _WORDS)
    count, parts = blocks(benchmark, item_col, item_text, window)
    if count == 1:
        sent = spark.sparkContext.broadcast(next(parts))
        return mapped(documents, _marked(sent, text_col, False), T.StructType([*documents.schema.fields, *_ADDED]))
    rows = keep(spark, documents.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    texts = rows.select(_ROW, text_col)
    found = None
    for tests in parts:
        sent = spark.sparkContext.broadcast(tests)
        part = keep(spark, mapped(texts, _marked(sent, text_col, True), T.StructType([T.StructField(_ROW, T.LongType()), *_ADDED])), "marks")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy(_ROW).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(_HITS)))).alias(_HITS), F.array_sort(F.array_distinct(F.flatten(F.collect_list(_ITEMS)))).alias(_ITEMS)
    )  # a row of each block at most
    none = spark.sparkContext.broadcast(TestSuffixes([], [], window))
    counted = mapped(rows, _marked(none, text_col, False), T.StructType([*rows.schema.fields, *_ADDED])).drop(_HITS, _ITEMS)
    filled = {_HITS: F.coalesce(_HITS, F.array().cast("array<int>")), _ITEMS: F.coalesce(_ITEMS, F.array().cast("array<string>"))}
    return counted.join(merged, _ROW, "left").withColumns(filled).drop(_ROW).select(*documents.columns, _HITS, _ITEMS, _WORDS)


def decontaminate(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any verbatim window of the benchmark; columns unchanged."""
    return mark(spark, documents, benchmark, window).where(F.size(_HITS) == 0).drop(_HITS, _ITEMS, _WORDS)


def report(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = mark(spark, documents.select("doc_id", "text"), benchmark.select("item_id", "text"), window)
    return marked.select(
        "doc_id",
        F.col(_WORDS).alias("n_words"),
        F.size(_HITS).cast("long").alias("n_hit"),
        F.size(_ITEMS).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.col(_ITEMS)).cast("binary"), 256).alias("items_sha256"),
        (F.size(_HITS) > 0).alias("contaminated"),
    )


def longest_matches(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, min_words: int = WINDOW) -> DataFrame:
    """Where benchmark text stands in documents: doc_id, item_id, item_start, doc_start, n_words
    (word positions). Each row is a match that can't be extended to either side."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("item_text"))
    marked = mark(spark, documents.select("doc_id", "text"), benchmark, min_words).where(F.size(_HITS) > 0)
    pairs = marked.select("doc_id", "text", F.explode(_ITEMS).alias("item_id")).join(items, "item_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                a = _hashes(r["text"])
                b = _hashes(r["item_text"])
                rows += [(r["doc_id"], r["item_id"], s, p, n) for s, p, n in _maximal(a, b, min(min_words, len(b)))]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), *(pa.array(c, pa.int64()) for c in cols[2:])], names=["doc_id", "item_id", "item_start", "doc_start", "n_words"])

    rows = pairs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "item_id", "item_text")
    return mapped(rows, task, "doc_id long, item_id string, item_start long, doc_start long, n_words long")


def _hashes(text: str) -> np.ndarray:
    return np.concatenate([w.hash for _, _, w in V.each_chunk(pa.array([text], pa.large_string()))])


def _maximal(doc: np.ndarray, item: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    places = defaultdict(list)
    for s, x in enumerate(item.tolist()):
        places[x].append(s)
    for p in np.flatnonzero(np.isin(doc, item)).tolist():
        for s in places[int(doc[p])]:
            if p and s and doc[p - 1] == item[s - 1]:
                continue
            m = min(len(doc) - p, len(item) - s)
            differ = np.flatnonzero(doc[p : p + m] != item[s : s + m])
            n = int(differ[0]) if len(differ) else m
            if least and n >= least:
                yield s, p, n
