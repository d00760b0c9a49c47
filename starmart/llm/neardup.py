"""MinHash document fingerprints, and near-duplicate pairs from signature bands.

Fingerprint: ``PERMUTATIONS`` universal hash functions over the five-word
shingles of the whole text, vectorised in numpy over megabytes of text at a time
(one pass of the text's bytes gives the word hashes, five of them a shingle's).
For each function the smallest value is kept, reduced to 16 bits. The share of
equal slots of two fingerprints estimates the Jaccard similarity of their shingles
(standard error at most 0.5 / sqrt(PERMUTATIONS)).

A text of one to four words has one shingle, all its words; a text without words
has none, and a fingerprint of its own: it is like other such texts
only. A null text is empty. Equal texts have equal fingerprints, wherever they
are computed.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starmart.llm import textvec as V
from starmart.llm.common import keep, mapped, ship
from starmart.llm.components import components
from starmart.llm.ngram_join import CELL, cells_in, deal, intersections, set_key, unmet, verify

SHINGLE = 5
PERMUTATIONS = 128
THRESHOLD = 0.8
_A, _B = V.permutations(PERMUTATIONS)


def sketch(texts: pa.Array) -> np.ndarray:
    """uint16 signatures, one row a text."""
    return V.signatures(texts, SHINGLE, _A, _B)


def as_text(sig: np.ndarray) -> list[str]:
    """Signatures as base64 of little-endian 16-bit slots."""
    data = np.ascontiguousarray(sig, dtype="<u2")
    return [base64.b64encode(row.tobytes()).decode() for row in data]


def fingerprints(documents: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``documents`` with a string column ``out``; everything else passes through."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(n, batch[n]) for n in batch.schema.names if n != out]
            yield pa.RecordBatch.from_arrays([c for _, c in own] + [pa.array(as_text(sketch(batch[text_col])), pa.string())], names=[n for n, _ in own] + [out])

    kept = documents.drop(out)
    return mapped(kept, task, T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())]))


def followed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Documents dealt out so that a task reads runs of consecutive ids, each run ended by the first
    document after it: columns part, id, text, extra (true for that one document).

    The cuts are quantiles of the ids (as many as shuffle partitions); which document follows each run
    comes from one row a run. Texts are shuffled once. Ids are ordered with nulls first, equal
    ids by their texts; rows of one id stay in one run.
    """
    spark = documents.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 10_000).alias("c")).head()["c"] or []
    places = np.array(sorted(set(cuts)), dtype=np.int64)
    low = np.iinfo(np.int64).min
    ship(spark)

    @F.arrow_udf("int")
    def run_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(places, pc.fill_null(ids, low).to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    rows = rows.withColumn("part", run_of("id"))
    heads = {r["part"]: r["h"] for r in rows.groupBy("part").agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("h")).collect()}
    used = sorted(heads)
    before = {used[i]: used[i - 1] for i in range(len(used))}  # the first run follows the last
    if not used:
        return rows.withColumn("extra", F.lit(False)), n
    # the head of each run goes to the run before it too; of several rows with its id, the task takes the first
    ids = {heads[p]["id"]: before[p] for p in used}

    @F.arrow_udf("int")
    def run_before(col: pa.Array) -> pa.Array:
        return pa.array([ids.get(x) for x in col.to_pylist()], pa.int32())

    to = run_before("id")
    extra = rows.withColumn("to", to).where(F.col("to").isNotNull()).select("id", "text", F.col("to").alias("part"), F.lit(True).alias("extra"))
    both = rows.select("id", "text", "part", F.lit(False).alias("extra")).unionByName(extra)
    return both.repartition(n, "part").sortWithinPartitions("part", "extra", F.col("id").asc_nulls_first(), "text"), n


def report(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to the edited text and the
    next document. Edited: the last quarter of the code points replaced by as many first ones of the next."""
    rows, _ = followed(documents)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last document, whose successor is still to come: part, id, text, signature, extra

        def emit(items):
            """items: documents in order, each followed by the next within its run."""
            out = []
            edited_texts = []
            for a, b in zip(items, items[1:]):
                if a[4] or a[0] != b[0]:
                    continue
                q = len(a[2]) // 4
                edited = a[2][: len(a[2]) - q] + b[2][:q]
                edited_texts.append(edited)
                out.append((a, b))
            if not out:
                return None
            es = sketch(pa.array(edited_texts, pa.large_string()))
            own = np.array([a[3] for a, _ in out])
            nxt = np.array([b[3] for _, b in out])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([a[1] for a, _ in out], pa.int64()),
                    pa.array([len(a[2]) for a, _ in out], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited_texts]),
                    pa.array(as_text(own)),
                    pa.array(as_text(es)),
                    pa.array((own == es).mean(axis=1)),
                    pa.array((own == nxt).mean(axis=1)),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                sig = sketch(part["text"])
                items = list(zip(part["part"].to_pylist(), part["id"].to_pylist(), part["text"].to_pylist(), sig, part["extra"].to_pylist()))
                items = ([held] if held is not None else []) + items
                got = emit(items)
                if got is not None:
                    yield got
                held = items[-1]

    return mapped(rows, task, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, fingerprint and key (16 bytes that stand for the shingle set; null without words)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes | None] = []
            for i, j, w in V.each_chunk(batch["text"]):
                values, begin = w.shingles(SHINGLE)
                keys += [set_key(values[begin[d] : begin[d + 1]]) for d in range(j - i)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text"], pa.array(as_text(sketch(batch["text"])), pa.string()), pa.array(keys, pa.binary())], names=["id", "text", "fingerprint", "key"])

    src = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return mapped(src, task, T.StructType([*src.schema.fields, T.StructField("fingerprint", T.StringType()), T.StructField("key", T.BinaryType())]))


def banded_cells(spark: SparkSession, documents: DataFrame, rows_in_band: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: id, key; classes: key, id, node, copies; cells of ``ngram_join.deal`` with id, copies and text).

    Documents of equal shingle sets are one class with its smallest id. Bands of the signatures are joined in Spark:
    in each band's bucket every class points at the smallest one, so a bucket of n classes gives n-1 edges. Any two
    classes of a bucket meet in one cell: two chunks of about ``CELL`` classes.
    """
    rows = keep(spark, keyed(documents, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()), "fingerprints")
    classes = keep(spark, rows.where("key is not null").groupBy("key").agg(F.min("id").alias("id"), F.min("rid").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")
    size = rows_in_band * 2
    raw = F.unbase64("fingerprint")
    hashes = F.array(*[F.xxhash64(F.substring(raw, 1 + b * size, size)) for b in range(PERMUTATIONS // rows_in_band)])
    texts = rows.withColumnRenamed("rid", "node").select("node", "text", hashes.alias("bands"))
    bands = texts.join(classes.select("node"), "node", "left_semi").select("node", F.posexplode("bands").alias("band", "b"))
    return rows.select("id", "key"), classes, deal(spark, bands, classes.select("node", "id", "copies"), texts, CELL)


def near_pairs(spark: SparkSession, documents: DataFrame, rows_in_band: int = 4, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All near-duplicate links between different shingle sets that share a band: a, b, jaccard, verified on the
    exact sets. A set is named by the smallest id of its documents (a the smaller one); sets without any id
    are left out. A group of n similar sets has up to n(n-1)/2 links; ``near_groups`` is linear.
    """
    exact = Fraction(str(threshold))
    _, _, cells = banded_cells(spark, documents, rows_in_band, id_col, text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first, earlier in cells_in(batches, "id", "text"):
            x, y, j = cell_pairs(shingle_sets(pa.array([r[2] for r in rows], pa.large_string())), first, exact, earlier)
            ids = pa.array([r[1] for r in rows], kind)
            if len(x):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(x)), ids.take(pa.array(y)), pa.array(j)], names=["x", "y", "jaccard"])

    field = documents.schema[id_col].dataType
    kind = to_arrow_type(field)
    links = mapped(cells.where("id is not null"), task, T.StructType([T.StructField("x", field), T.StructField("y", field), T.StructField("jaccard", T.DoubleType())]))
    return links.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard")


def near_groups(spark: SparkSession, documents: DataFrame, rows_in_band: int = 4, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, class_id (smallest id of all documents connected with it by links) and n_links
    (other documents of an equal set or linked with it). Texts without words have no link and their own id."""
    rows, classes, cells = banded_cells(spark, documents, rows_in_band, id_col, text_col)
    checked = keep(spark, verify(cells.drop("id"), SHINGLE, threshold), "links")
    groups = components(spark, checked.select(F.col("root").alias("a"), F.col("node").alias("b")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(links, "node", "left").join(groups, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = known.groupBy("comp").agg(F.min("id").alias("class_id"))
    result = known.join(named, "comp").select("key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    of = rows.join(result, "key", "left")
    return of.select(F.col("id").alias(id_col), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def cell_pairs(sets: list[np.ndarray], first: np.ndarray, threshold: Fraction, earlier: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs of one cell: indices, indices, Jaccard. ``first``: member of the first chunk; if all are,
    all pairs are compared, else those across. ``earlier`` as in ``ngram_join.cell_links``."""
    whole = bool(first.all())
    left = np.flatnonzero(first)
    right = left if whole else np.flatnonzero(~first)
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    both = intersections(sets, left, right)
    size = np.array([len(s) for s in sets])
    union = size[left][:, None] + size[right][None, :] - both
    linked = both * threshold.denominator >= union * threshold.numerator
    if earlier is not None:
        linked &= unmet(earlier[left], earlier[right])
    if whole:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    return left[i], right[j], both[i, j] / union[i, j]


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for i, j, w in V.each_chunk(texts):
        values, begin = w.shingles(n)
        out += [np.unique(values[begin[d] : begin[d + 1]]) for d in range(j - i)]
    return out
