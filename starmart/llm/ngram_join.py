"""N-gram Jaccard self-join: MinHash banding, then all links verified on the full n-gram sets.

1. Every text becomes its set of five-word shingles. Texts of equal sets are one class
   (a group of copies of any size is one row from here on), aggregated before and after one shuffle.
2. MinHash signatures are cut into bands; ``choose_bands`` takes the longest rows that
   still find a pair at the threshold with the target recall. Classes are shuffled on band
   hashes; in each bucket every class points at the smallest one, n-1 edges for n classes.
   The connected parts of these edges hold every pair that shares a bucket.
3. Each part is verified in cells. A part of up to ``CELL`` classes is one cell; a
   larger one is dealt into chunks, and each pair of chunks is a cell, so a task holds
   2 * ``CELL`` texts at most. Where a large part is but a chain of small buckets, its buckets are dealt that
   way instead of the part, whichever ships fewer texts; a pair counts in its first common band only. So a group of
   n copies costs n^2 comparisons, a chain of n texts about n. In a cell all pairs are compared exactly (intersections
   as products of 0/1 blocks of shared shingles); what leaves it is linear: number of
   links by class, and for each connected group an edge from its smallest class to each other.
4. The verified edges' components are the near-duplicate groups.

Defined results: a text of one to four words is one shingle; a text without words (null,
empty, only marks) has no n-grams, no link and its own id as class. Documents of equal
n-gram sets are linked. A class without any id has class id null. Repeated rows get the same
result each. An empty table gives no rows. Further columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm import textvec as V
from starmart.llm.common import keep, mapped
from starmart.llm.components import components, hub_join

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999  # for a pair exactly at the threshold
MAX_PERMUTATIONS = 192
CELL = 256  # classes in a chunk


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_PERMUTATIONS) -> tuple[int, int]:
    """(bands, rows): the longest rows, so the fewest chance meetings, for which bands that reach
    the recall at the threshold need at most ``most`` permutations."""
    best = None
    for rows in range(1, most + 1):
        p = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-p)) if p < 1 else 1
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError("the recall can't be reached with so few permutations")
    return best


def sketches(documents: DataFrame, id_col: str, text_col: str, bands: int, rows: int, n: int) -> DataFrame:
    """id, text, rest (the other columns), key (16 bytes that stand for the n-gram set; null without words) and band hashes."""
    a, b = V.permutations(bands * rows, seed=7)
    salt = V.permutations(bands * rows, seed=8)[0]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes | None] = []
            hashes: list[np.ndarray] = []
            for i, j, w in V.each_chunk(batch["text"]):
                values, begin = w.shingles(n)
                low = V.mix(V.minima(values, begin, a, b)) * salt
                hashes += list(V.mix(np.add.reduceat(low, np.arange(0, bands * rows, rows), axis=1)).view(np.int64))
                keys += [set_key(values[begin[d] : begin[d + 1]]) for d in range(j - i)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * bands), pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text"], batch["rest"], pa.array(keys, pa.binary()), lists], names=["id", "text", "rest", "key", "bands"])

    others = [c for c in documents.columns if c not in (id_col, text_col)]
    pad = "_" * (1 + max((len(c) for c in others if not c.strip("_")), default=0))  # a struct needs a field
    src = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(F.lit(0).alias(pad), *[F.col(f"`{c}`") for c in others]).alias("rest"))
    return mapped(src, task, T.StructType([*src.schema.fields, T.StructField("key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]))


def set_key(values: np.ndarray) -> bytes | None:
    """Order-free 128-bit hash of a set of shingle hashes; equal sets have equal keys."""
    if not len(values):
        return None
    u = np.unique(values)
    x = V.mix(u * V.POS[40] + V.POS[41])
    y = V.mix(u * V.POS[42] + V.POS[43])
    return int(x.sum()).to_bytes(8, "little") + int(y.sum() + np.uint64(len(u))).to_bytes(8, "little")


def _sets(texts: list[str], n: int) -> list[np.ndarray]:
    out = []
    for i, j, w in V.each_chunk(pa.array(texts, pa.large_string())):
        values, begin = w.shingles(n)
        out += [np.unique(values[begin[d] : begin[d + 1]]) for d in range(j - i)]
    return out


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the ``left`` with the ``right`` sets (indices)."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    v, owner = flat[order], owner[order]
    new = np.append(True, v[1:] != v[:-1])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    if not len(column):
        return out
    column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
    at = np.searchsorted(column, np.arange(0, column[-1] + 2048, 2048))
    for k in range(len(at) - 1):
        block = np.zeros((len(sets), 2048), dtype=np.float32)
        block[owner[at[k] : at[k + 1]], column[at[k] : at[k + 1]] - 2048 * k] = 1
        out += block[left] @ block[right].T
    return np.rint(out).astype(np.int64)


def cell_links(texts: list[str], copies: list[int], first: np.ndarray, n: int, threshold: Fraction, earlier: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of one cell: links of each text (each counts the copies of its partner), and the smallest
    index connected with it. ``first``: member of the first chunk; if all are, all pairs are compared, else those across.
    ``earlier``: the texts' hashes in bands before the cell's; a pair with an equal one is left to that band."""
    sets = _sets(texts, n)
    whole = bool(first.all())
    left = np.flatnonzero(first)
    right = left if whole else np.flatnonzero(~first)
    links, root = np.zeros(len(texts), dtype=np.int64), np.arange(len(texts))
    if not len(left) or not len(right):
        return links, root
    both = intersections(sets, left, right)
    size = np.array([len(s) for s in sets])
    union = size[left][:, None] + size[right][None, :] - both
    linked = both * threshold.denominator >= union * threshold.numerator
    if earlier is not None:
        linked &= unmet(earlier[left], earlier[right])
    if whole:
        np.fill_diagonal(linked, False)
    weight = np.array(copies, dtype=np.int64)
    links[left] += linked @ weight[right]
    if not whole:
        links[right] += linked.T @ weight[left]
    i, j = np.nonzero(linked)
    i, j = left[i], right[j]
    while True:  # the smallest root spreads along the links, then along the roots
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return links, root
        root = low


def unmet(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the left rows have no column's value in common with which of the right ones."""
    out = np.ones((len(left), len(right)), dtype=bool)
    for k in range(left.shape[1]):
        out &= left[:, k][:, None] != right[:, k][None, :]
    return out


CELL_KEY = ("place", "band", "b", "i", "j")  # what names a cell; band -1: of a whole part


def cells_in(batches: Iterator[pa.RecordBatch], *cols: str) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray | None]]:
    """Of each cell in sorted rows: its members by node (node and ``cols``), which of them are in the first chunk, and their
    hashes in earlier bands (none for a cell of a whole part)."""

    def members():
        for batch in batches:
            yield from zip(*(batch[c].to_pylist() for c in (*CELL_KEY, "chunk", "earlier", "node", *cols)))

    k = len(CELL_KEY)
    for cell, found in groupby(members(), key=lambda r: r[:k]):
        rows = sorted(found, key=lambda r: r[k + 2])
        earlier = np.array([r[k + 1] for r in rows], dtype=np.int64).reshape(len(rows), cell[1]) if cell[1] > 0 else None
        yield [r[k + 2 :] for r in rows], np.array([r[k] == cell[3] for r in rows]), earlier


def deal(spark: SparkSession, banded: DataFrame, classes: DataFrame, texts: DataFrame, cell: int) -> DataFrame:
    """Cells of all texts that share a band hash with another: ``CELL_KEY``, chunk, earlier and the columns of ``classes``
    and ``texts``; sorted by cell within partitions. ``banded``: node, band, b (one row a class and band);
    ``classes``: node and others; ``texts``: node, bands (its hashes in band order) and others."""
    first = banded.groupBy("band", "b").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = keep(spark, first.withColumn("rows", F.col("n")), "first")
    in_buckets = first.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    met = keep(spark, hub_join(banded, first, ["band", "b"], "rows", in_buckets), "buckets")
    parts = keep(spark, components(spark, met.where("node <> a").select("a", F.col("node").alias("b"))), "parts")
    chunks = lambda n: F.ceil(F.col(n) / cell).cast("int")
    size = parts.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    heads = met.where("node = a").select("node", (F.col("n") * chunks("n")).alias("shipped"))
    by_bucket = heads.groupBy("node").agg(F.sum("shipped").alias("shipped")).join(parts, "node").groupBy("comp").agg(F.sum("shipped").alias("shipped"))
    how = size.join(by_bucket, "comp").select("comp", chunks("size").alias("m"), (F.col("size") * chunks("size") > F.col("shipped")).alias("split"), F.col("size").alias("rows"))
    how = keep(spark, how, "how")
    placed = hub_join(parts, how, "comp", "rows", parts.count()).join(classes, "node")
    others = [c for c in classes.columns if c != "node"]
    whole = placed.where(~F.col("split")).select("node", *others, F.col("comp").alias("place"), F.lit(-1).alias("band"), F.lit(0).cast("long").alias("b"), "m")
    split = met.join(placed.where("split").select("node", *others), "node").select("node", *others, F.col("a").alias("place"), "band", "b", chunks("n").alias("m"))
    dealt = texts.join(whole.unionByName(split).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("m")).cast("int")), "node")
    dealt = dealt.withColumn("earlier", F.when(F.col("band") > 0, F.slice("bands", 1, F.greatest(F.col("band"), F.lit(0))))).drop("bands")
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).withColumns({"i": F.least("chunk", "o"), "j": F.greatest("chunk", "o")}).drop("o", "m")
    return dealt.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY)


def verify(cells: DataFrame, n: int, threshold: float) -> DataFrame:
    """Rows node, links, root for each member of each cell of ``deal``."""
    exact = Fraction(str(threshold))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows, first, earlier in cells_in(batches, "copies", "text"):
            links, root = cell_links([r[2] for r in rows], [r[1] for r in rows], first, n, exact, earlier)
            out += [(r[0], int(x), rows[g][0]) for r, x, g in zip(rows, links, root)]
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return mapped(cells, task, "node long, links long, root long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["node", "links", "root"])


def grouped(spark: SparkSession, documents: DataFrame, id_col: str, text_col: str, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(rows: id, text, rest, key, rid; classes: key, class_id, n_links, kept: the rid of the group's first row)."""
    bands, rows = choose_bands(threshold, recall)
    sk = sketches(documents, id_col, text_col, bands, rows, n)
    sk = keep(spark, sk.withColumn("rid", F.monotonically_increasing_id()), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")).alias("h")
    classes = keep(spark, sk.where("key is not null").groupBy("key").agg(first, F.count(F.lit(1)).alias("copies")).select("key", "h", "h.rid", "copies"), "classes")
    # the band hashes of one row of each class; classes go by its rid
    node = F.col("rid").alias("node")
    banded = sk.join(classes.select("rid"), "rid", "left_semi").select(node, F.posexplode("bands").alias("band", "b"))
    cells = deal(spark, banded, classes.select(node, "copies"), sk.select(node, "text", "bands"), CELL)
    checked = keep(spark, verify(cells, n, threshold), "links")
    groups = components(spark, checked.select(F.col("root").alias("a"), F.col("node").alias("b")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.withColumnRenamed("rid", "node").join(links, "node", "left").join(groups, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = known.groupBy("comp").agg(F.min("h").alias("g"))
    result = known.join(named, "comp").select("key", F.col("g.id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("g.rid").alias("kept"))
    return sk, result


def ngram_join(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: the id, class_id (smallest id of its near-duplicate group) and n_links (other
    documents with a Jaccard similarity of the n-gram sets of at least ``threshold``)."""
    sk, classes = grouped(spark, documents.select(id_col, text_col), id_col, text_col, n, threshold, recall)
    own = sk.select("id", "key")
    with_words = own.where("key is not null").join(classes, "key").select("id", "class_id", "n_links")
    without = own.where("key is null").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return with_words.unionByName(without).withColumnRenamed("id", id_col)


def deduplicate(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of each near-duplicate group, that of the smallest id (rows without id come last);
    columns unchanged. Texts without words stay, each of them."""
    sk, classes = grouped(spark, documents, id_col, text_col, n, threshold, recall)
    kept = classes.select(F.col("kept").alias("rid")).distinct()
    rows = sk.where("key is not null").join(kept, "rid", "left_semi").unionByName(sk.where("key is null").select(*[c for c in sk.columns if c != "rid"], "rid"))
    named = {id_col: F.col("id"), text_col: F.col("text")}
    return rows.select(*[named.get(c, F.col(f"rest.`{c}`")).alias(c) for c in documents.columns])
