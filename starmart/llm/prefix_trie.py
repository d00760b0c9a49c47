"""Trie of the conversations' common beginnings, found by truncation peeling.

A conversation is its turns in the order (turn, null first; role; SHA-256 of the text), a turn the
SHA-256 digest of role and text with the text's number of code points. Equal conversations
are one sequence. A sequence's end that it shares with no other is peeled where it lies: its
nodes have that sequence's members alone. The walk goes from the deepest shared beginning up: the nodes of one depth, being
what survives of the next depth once its last turn is stripped and the sequences that
end at this depth, are grouped by their path; members, smallest member, children, childless nodes
and saved code points are aggregated in that same grouping. One grouping finds the nodes of a
depth and finishes them. Where a sequence becomes unshared is looked up at the depths 1, 2, 4, ..., so
there are less than twice as many rounds as the deepest shared beginning has turns, however long conversations are.

How it runs: a round shuffles paths (36 bytes a turn), combined before the shuffle, so that
a beginning shared by any number of conversations arrives as one row a task. Each round's nodes are
a table in the shared folder, and the next one starts from it. A node learns its parent's smallest member by a
join; parents of more than a thousandth of all nodes are broadcast (at most ``HOT_PARENTS`` rows),
so the shuffled rest has no hot key. The ids that end at a node are sorted by range,
joined to strings of up to ``CHUNK`` ids where they lie, and hashed from those strings: a hot
group of copies is spread over tasks, and one task streams n / ``CHUNK`` rows.

Null conv_id: the row belongs to no conversation and is left out. Null role or text: empty. Repeated
rows and equal turn numbers: each row is a turn, in the order above. Empty table: no node. Further
columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import keep, mapped, table

HOT_PARENTS = 1000
CHUNK = 10_000
SLICE = 10_000  # rows of a long tail given at a time
PATH = "array<struct<k: binary, c: int>>"
EMPTY = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, path: one row for each conversation, its turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = F.unhex(F.sha2(text, 256))
    turn = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text).cast("binary"), 256))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("t"), role.alias("r"), own.alias("o"), turn.alias("k"), F.char_length(text).alias("c")).alias("x"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.struct(x["k"].alias("k"), x["c"].alias("c"))).alias("path"))


def rebuilt(convs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations that share beginnings: the first h turns of conversation c - c % ``every``, then c's own
    turns after its first h, with h = crc32 of the id in decimals, modulo ``most``."""
    base = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("path", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(base, "base", "left").withColumn("h", h)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(PATH))
    own = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, own).alias("path"))


def _key(path) -> F.Column:
    """Digest of a path."""
    return F.unhex(F.sha2(F.array_join(F.transform(path, lambda x: F.hex(x["k"])), ""), 256))


def ends(convs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """key, ends_sha256: for each sequence the hash of its conversations' ids, ascending and comma-joined."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())], names=["key", "first", "ids"])

        for batch in batches:
            for k, c in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (k != key or len(ids) >= chunk):
                    yield row()
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield row()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, out = [], []
            for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
                if k != key:
                    if state is not None:
                        keys.append(key)
                        out.append(state.hexdigest())
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], names=["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    rows = convs.select(_key(F.col("path")).alias("key"), "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = mapped(rows, joined, "key binary, first long, ids string")
    return mapped(chunks.repartition("key").sortWithinPartitions("key", "first"), hashed, "key binary, ends_sha256 string")


def private_from(sequences: DataFrame) -> DataFrame:
    """conv_id, first: a depth from which on a sequence's beginnings are its own alone, looked for at the
    depths 1, 2, 4, ... Every sequence that long has a probe there, so a key found once is one sequence's. Sequences
    without such a depth aren't listed."""
    powers = F.expr("transform(sequence(0, cast(floor(log2(size(path))) as int)), k -> shiftleft(1, k))")
    probes = sequences.where(F.size("path") > 0).select("conv_id", "path", F.explode(powers).alias("depth"))
    beginnings = probes.select("conv_id", "depth", _key(F.slice("path", F.lit(1), F.col("depth"))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"))
    return beginnings.where("n = 1").groupBy("conv_id").agg(F.min("depth").alias("first"))


def tails(sequences: DataFrame) -> DataFrame:
    """Nodes that one sequence has alone, peeled where it lies. ``key`` stands at its end, ``parent`` at the first of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, n, first, chars, key, parent in zip(*(batch[c].to_pylist() for c in ("conv_id", "n_convs", "first", "chars", "key", "parent"))):
                saved = (n - 1) * np.cumsum(np.array(chars[first - 1 :], dtype=np.int64)[::-1])[::-1]
                for k in range(0, len(saved), SLICE):
                    m = min(SLICE, len(saved) - k)
                    depth = np.arange(first + k, first + k + m)
                    ends_here, first_here = depth == len(chars), depth == first
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key if e else None for e in ends_here], pa.binary()),
                            pa.array([parent if e else None for e in first_here], pa.binary()),
                            pa.array(depth, pa.int64()),
                            pa.array([conv] * m, pa.int64()),
                            pa.array([None if e else conv for e in first_here], pa.int64()),
                            pa.array([n] * m, pa.int64()),
                            pa.array((~ends_here).astype(np.int64)),
                            pa.array([1] * m, pa.int64()),
                            pa.array(saved[k : k + m]),
                        ],
                        names=["key", "parent", "depth", "conv_id", "known", "n_convs", "n_children", "n_leaves", "saved_tokens"],
                    )

    rows = sequences.where("first is not null").select("conv_id", "n_convs", "first", F.transform("path", lambda x: x["c"]).alias("chars"), _key(F.col("path")).alias("key"), _key(F.slice("path", F.lit(1), F.col("first") - 1)).alias("parent"))
    return mapped(rows, task, "key binary, parent binary, depth long, conv_id long, known long, n_convs long, n_children long, n_leaves long, saved_tokens long")


def peel(spark: SparkSession, sequences: DataFrame) -> list[DataFrame]:
    """Shared nodes by depth, deepest first: path, depth, conv_id, n_convs, n_children, n_leaves, saved_tokens."""
    zero, one = (F.lit(k).cast("long") for k in (0, 1))
    tail = F.col("first").isNotNull()
    left = F.aggregate(F.slice("path", F.col("first"), F.size("path") - F.col("first") + 1), zero, lambda a, x: a + x["c"])
    whole = sequences.select(
        F.when(tail, F.slice("path", F.lit(1), F.col("first") - 1)).otherwise(F.col("path")).alias("path"),
        "n_convs",
        "conv_id",
        tail.cast("long").alias("child"),
        tail.cast("long").alias("n_leaves"),
        F.when(tail, (F.col("n_convs") - 1) * left).otherwise(zero).alias("saved"),
    )
    whole = keep(spark, whole, "ending")
    deepest = whole.agg(F.max(F.size("path"))).head()[0]
    levels: list[DataFrame] = []
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        rows = whole.where(F.size("path") == depth)
        if levels:
            stripped = levels[-1].select(F.slice("path", 1, depth).alias("path"), "n_convs", "conv_id", one.alias("child"), "n_leaves", F.col("saved_tokens").alias("saved"))
            rows = rows.unionByName(stripped)
        found = rows.groupBy("path").agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("child").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
        last = F.coalesce(F.try_element_at("path", F.lit(-1))["c"].cast("long"), zero)
        nodes = found.select("path", F.lit(depth).cast("long").alias("depth"), "conv_id", "n_convs", "n_children", F.greatest("leaves", one).alias("n_leaves"), (F.col("saved") + (F.col("n_convs") - 1) * last).alias("saved_tokens"))
        levels.append(keep(spark, nodes, f"nodes-{depth}"))
    return levels


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def trie(spark: SparkSession, convs: DataFrame, hot_parents: int = HOT_PARENTS, chunk: int = CHUNK) -> DataFrame:
    """One row for each node of the trie over ``convs`` (conv_id, path)."""
    sequences = keep(spark, convs.groupBy("path").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")), "distinct")
    sequences = keep(spark, sequences.join(private_from(sequences), "conv_id", "left"), "sequences")
    levels = peel(spark, sequences)
    if not levels:
        return spark.createDataFrame([], NODE)
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    parent = F.when(F.col("depth") > 0, _key(F.slice("path", F.lit(1), F.greatest(F.size("path") - 1, F.lit(0)))))
    nodes = nodes.withColumns({"key": _key(F.col("path")), "parent": parent, "known": F.lit(None).cast("long")}).drop("path")
    nodes = keep(spark, nodes.unionByName(tails(sequences)), "trie")
    least = nodes.count() // hot_parents
    inner = nodes.where("n_children > 0 and key is not null").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = inner.where(F.col("n_children") > least).select("parent", F.col("parent_conv_id").alias("hot_conv_id"))
    rest = inner.where(F.col("n_children") <= least).drop("n_children")
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    placed = nodes.join(F.broadcast(hot), "parent", "left")
    # nodes of hot parents and of tails are done; only the others meet the table of parents
    done = placed.where("hot_conv_id is not null or parent is null").withColumn("parent_conv_id", F.coalesce("hot_conv_id", "known"))
    open_ = placed.where("hot_conv_id is null and parent is not null").join(rest, "parent", "left")
    placed = done.select("key", *shown).unionByName(open_.select("key", *shown))
    # inside a tail nothing ends
    ending = placed.where("key is not null").join(ends(convs, chunk), "key", "left").select(*shown, F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    return ending.unionByName(placed.where("key is null").select(*shown, F.lit(EMPTY).alias("ends_sha256")))


def report(spark: SparkSession, d: str) -> DataFrame:
    """Trie of the rebuilt conversations of a folder's table."""
    convs = rebuilt(turns_of(table(spark, d, "conversations")))
    return trie(spark, keep(spark, convs, "rebuilt"))


ORACLE = """
WITH t AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), steps AS (
    SELECT conv_id, turns, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1])) AS bits FROM t
), hashed AS (
    SELECT conv_id, turns, CAST(xor(4294967295, list_reduce(bits, lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, 4294967295)) % 6 AS INT) AS h FROM steps
), built AS (
    SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path
    FROM hashed a LEFT JOIN t b ON b.conv_id = a.conv_id - a.conv_id % 100
), prefixes AS (
    SELECT conv_id, len(path) AS n, unnest(range(0, len(path) + 1)) AS depth, path FROM built
), nodes AS (
    SELECT path[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth) AS ids
    FROM prefixes GROUP BY 1, 2
), kids AS (SELECT path[1:depth - 1] AS parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (
    SELECT o.*, coalesce(k.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(o.path[depth].x) END AS own
    FROM nodes o LEFT JOIN kids k ON k.parent = o.path
), up AS (SELECT path[1:a] AS top, own, n_children FROM (SELECT path, own, n_children, unnest(range(0, depth + 1)) AS a FROM full_nodes)),
subtree AS (SELECT top, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM up GROUP BY 1)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(o.n_convs AS BIGINT) AS n_convs,
       CAST(o.n_children AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(o.ids, '')) AS ends_sha256
FROM full_nodes o JOIN subtree s ON s.top = o.path
LEFT JOIN full_nodes p ON o.depth > 0 AND p.path = o.path[1:o.depth - 1]
"""
