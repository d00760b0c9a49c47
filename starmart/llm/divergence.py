"""How far the sources of a language differ in their words.

Terms are the maximal runs of letters (A-Z, a-z and everything beyond ASCII; A-Z lower-cased). A
language keeps the terms that at least ``MIN_DOCS`` of its documents hold. A group is a language's
source; with a term's count in it and N the sum of its counts over the kept terms, the
term's smoothed share is p = 1 + floor(10^9 (count + 5) / (N + 5 V)). Two groups differ by the sum of
abs(p - q) over all kept terms; a group's own terms are those whose share exceeds the language's.

Method: p depends on a group and a count alone, so terms enter as one-hot columns, one for each
(group, count level) that occurs, zero included. The product of a tile of terms with its
transpose is the joint table of every two groups: how many terms have level a in one and
level b in the other. The tables of all tiles add up; a pair's distance is its table priced
with abs(p(a) - q(b)). Indicators are 0 or 1, a product at most the tile's height, so float32
holds it exactly; shares and sums are integers.

How it runs: counts by (lang, source, term) are combined in the tasks that read the texts and
shuffled by term, which spreads a source with most rows. Kept terms are dealt to blocks of some ``BLOCK`` terms, groups
to panels of ``PANEL``; a task holds one (block, two panels) at a time, whatever
the number of terms and groups (terms that none of a cell's groups has are counted, not listed), and gives one partial sum for a pair. The result is quadratic in a
language's sources since all pairs are asked for; nothing else is.

Null text, lang or source: empty text, the language or source ''. Repeated rows: a document each.
A language without kept terms: value 0 for all its pairs. Empty table: no rows. Ties: by the item's UTF-8
bytes. Further columns aren't read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import keep, mapped

MIN_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP = 50
BLOCK = 2048  # terms of a task's block
PANEL = 32  # groups of a panel
TILE = 128  # terms of one product
HELD = 300_000  # counters of a task
_TO_TERMS = bytes((b + 32 if 65 <= b <= 90 else b) if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """UTF-8 terms of a text."""
    return (text or "").encode("utf-8", "replace").translate(_TO_TERMS).split(b" ")


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents); a group without terms has one row with a null term."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for text, lang, source in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), batch["source"].to_pylist()):
                n, df = groups.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                own = Counter(terms_of(text))
                own.pop(b"", None)
                n.update(own)
                df.update(own.keys())
                held += len(n) - before
                if held > HELD:
                    yield from _count_rows(groups)
                    groups, held = {}, 0
        yield from _count_rows(groups)

    empty = F.lit("")
    rows = documents.select(F.coalesce("text", empty).alias("text"), F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"))
    parts = mapped(rows, task, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _count_rows(groups: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, df) in groups.items():
        terms = [None, *n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array([t and t.decode() for t in terms], pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *(df[t] for t in n)], pa.int64())],
            names=["lang", "source", "term", "n", "df"],
        )


def share(count, total, terms):
    """p of a count: 1 + floor(10^9 (count + 5) / (N + 5 V)), exact for counts up to 10^18."""
    wide = (F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(19,0)")).cast("decimal(38,0)")
    whole = (total + PRIOR * terms).cast("decimal(38,0)")
    return F.when(whole > 0, F.call_function("div", wide, whole) + 1).otherwise(F.lit(0)).cast("long")


class Audit:
    """Tables of a corpus that the reports are made of: ``kept`` (lang, source, term, n, p, all_n, q: a kept term's count
    and share in the group, and in the language) and ``groups`` (lang, source, g: number in the language, p0: share of a term that the
    group lacks, v: kept terms)."""

    def __init__(self, spark: SparkSession, documents: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK, panel: int = PANEL, tile: int = TILE):
        self.block, self.panel, self.tile = block, panel, tile
        counts = keep(spark, term_counts(documents), "term_counts")
        words = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("all_n")).where(F.col("df") >= min_docs).select("lang", "term", "all_n")
        words = keep(spark, words, "kept_terms")
        self.words = words
        langs = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("all_total"))
        # a kept term has as many rows as its language has sources, so the join has no hot key
        rows = counts.where("term is not null").drop("df").join(words, ["lang", "term"])
        rows = keep(spark, rows, "kept_counts")
        totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        zero = F.lit(0).cast("long")
        groups = counts.where("term is null").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["v", "all_total", "total"])
        groups = groups.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1).withColumn("p0", share(zero, F.col("total"), F.col("v")))
        self.groups = keep(spark, groups, "groups")
        facts = self.groups.select("lang", "source", "g", "total", "v", "all_total")
        self.kept = rows.join(facts, ["lang", "source"]).select("lang", "source", "g", "term", "n", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("all_n"), F.col("all_total"), F.col("v")).alias("q"), "v")

    def _tiles(self, task, schema: str) -> DataFrame:
        """Runs a task over (block, panel, panel) cells: the cell's groups (null term), then its terms' rows."""
        panel = F.floor(F.col("g") / self.panel).cast("long")
        blocks = F.ceil(F.col("v") / self.block).cast("long")
        groups = self.groups.where("v > 0").withColumn("panel", panel)
        sizes = groups.groupBy("lang").agg((F.max("panel") + 1).alias("panels"))
        rows = self.kept.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "g", panel.alias("panel"), "term", "n", "p")
        langs = groups.groupBy("lang").agg(F.max("v").alias("v"))
        terms = self.words.join(langs, "lang").groupBy("lang", F.pmod(F.xxhash64("term"), blocks).alias("block")).agg(F.count(F.lit(1)).alias("n"))
        # a cell's groups, each with the number of the block's terms
        rows = rows.unionByName(groups.join(terms, "lang").select("lang", "block", "g", "panel", F.lit(None).cast("string").alias("term"), "n", F.col("p0").alias("p")))
        # a panel's rows go to the cells of that panel with every other one
        cells = rows.join(sizes, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("panels") - 1)))
        cells = cells.select("lang", "block", F.least("panel", "other").alias("i"), F.greatest("panel", "other").alias("j"), "g", "term", "n", "p")
        return mapped(cells.repartition("lang", "block", "i", "j").sortWithinPartitions("lang", "block", "i", "j", "term", "g"), task, schema)

    def joint_tables(self) -> DataFrame:
        """lang, g, level, other_g, other_level, n: the number of kept terms that have one count in a group and the other in another (g < other_g)."""

        panel, tile = self.panel, self.tile

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (lang, _, i, j), g, level, _, x, y, n in _cells(batches, panel, tile):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(g[x]), pa.array(level[x]), pa.array(g[y]), pa.array(level[y]), pa.array(n)], names=["lang", "g", "level", "other_g", "other_level", "n"])

        parts = self._tiles(task, "lang string, g long, level long, other_g long, other_level long, n long")
        return parts.groupBy("lang", "g", "level", "other_g", "other_level").agg(F.sum("n").alias("n"))

    def distances(self) -> DataFrame:
        """lang, g, other_g, value for each two groups (g < other_g) of a language with kept terms."""

        panel, tile = self.panel, self.tile

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, sums = None, {}

            def rows() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([at[0]] * len(sums), pa.string()), pa.array([k[0] for k in sums], pa.int64()), pa.array([k[1] for k in sums], pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["lang", "g", "other_g", "value"])

            for cell, g, _, p, x, y, n in _cells(batches, panel, tile):
                if cell != at:
                    if sums:
                        yield rows()
                    at, sums = cell, {}
                price = n * np.abs(p[x] - p[y])
                lo, hi = g[x].min(), g[y].min()
                pair = (g[x] - lo) * (2 * panel) + (g[y] - hi)
                order = np.argsort(pair, kind="stable")
                pair = pair[order]
                starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
                for k, v in zip(pair[starts].tolist(), np.add.reduceat(price[order], starts).tolist()):
                    key = (k // (2 * panel) + int(lo), k % (2 * panel) + int(hi))
                    sums[key] = sums.get(key, 0) + v
            if sums:
                yield rows()

        parts = self._tiles(task, "lang string, g long, other_g long, value long")
        return parts.groupBy("lang", "g", "other_g").agg(F.sum("value").alias("value"))

    def pairs(self) -> DataFrame:
        """lang, source, item (another source of the language), value; both ways round."""
        half = self.distances()
        both = half.unionByName(half.select("lang", F.col("other_g").alias("g"), F.col("g").alias("other_g"), "value"))
        a = self.groups.select("lang", "g", "source", "v")
        b = self.groups.select("lang", F.col("g").alias("other_g"), F.col("source").alias("item"))
        named = both.join(a.drop("v"), ["lang", "g"]).join(b, ["lang", "other_g"]).select("lang", "source", "item", "value")
        # languages without kept terms: every pair is 0
        bare = a.where("v = 0").join(b, "lang").where("g <> other_g").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
        return named.unionByName(bare)

    def terms(self) -> DataFrame:
        """lang, source, item (a term), value: terms that a group has and uses more than its language."""
        return self.kept.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def _cells(batches: Iterator[pa.RecordBatch], panel: int, height: int):
    """For each tile of each cell: (cell, group, level and share of each one-hot column, row, column and number of each entry of its joint tables)."""
    at, zero, open_rows, size, seen = None, {}, [], 0, 0

    def tile():
        terms, gs, ns, ps = zip(*open_rows)
        number = {t: k for k, t in enumerate(dict.fromkeys(terms))}
        every = np.array(sorted(zero), dtype=np.int64)
        column = {int(g): k for k, g in enumerate(every)}
        level = np.zeros((len(number), len(every)), dtype=np.int64)
        price = np.broadcast_to(np.array([zero[int(g)] for g in every], dtype=np.int64), level.shape).copy()
        r, c = np.array([number[t] for t in terms]), np.array([column[g] for g in gs])
        level[r, c], price[r, c] = ns, ps
        # a number for each (group, level) that occurs
        order = np.argsort(level, axis=0, kind="stable")
        ranked = np.take_along_axis(level, order, axis=0)
        new = np.ones(ranked.shape, dtype=np.int64)
        new[1:] = ranked[1:] != ranked[:-1]
        ids = np.cumsum(new.T.ravel()).reshape(new.T.shape).T - 1
        hot = np.empty_like(ids)
        np.put_along_axis(hot, order, ids, axis=0)
        width = int(ids[-1, -1]) + 1
        g, lv, p = (np.empty(width, dtype=np.int64) for _ in range(3))
        g[hot], lv[hot], p[hot] = np.broadcast_to(every, hot.shape), level, price
        left, right = every // panel == at[2], every // panel == at[3]
        x = np.zeros((len(number), width), dtype=np.float32)
        np.put_along_axis(x, hot, 1, axis=1)
        a, b = np.flatnonzero(np.repeat(left, new.sum(axis=0))), np.flatnonzero(np.repeat(right, new.sum(axis=0)))
        joint = x[:, a].T @ x[:, b]
        i, j = np.nonzero(joint)
        n = joint[i, j].astype(np.int64)
        i, j = a[i], b[j]
        upper = g[i] < g[j]
        return at, g, lv, p, i[upper], j[upper], n[upper]

    def whole(cell_ends: bool):
        """The open tile, and at a cell's end the terms that none of its groups has."""
        if len(zero) > 1:
            if open_rows and len((out := tile())[-1]):
                yield out
            if cell_ends and size > seen:
                g = np.array(sorted(zero), dtype=np.int64)
                i, j = np.nonzero((g[:, None] < g) & (g[:, None] // panel == at[2]) & (g // panel == at[3]))
                if len(i):
                    yield at, g, np.zeros(len(g), dtype=np.int64), np.array([zero[k] for k in g.tolist()], dtype=np.int64), i, j, np.full(len(i), size - seen, dtype=np.int64)

    terms = 0
    for batch in batches:
        cells = zip(*(batch[c].to_pylist() for c in ("lang", "block", "i", "j")))
        for cell, term, g, n, p in zip(cells, *(batch[c].to_pylist() for c in ("term", "g", "n", "p"))):
            if cell != at:
                yield from whole(True)
                at, zero, open_rows, terms, seen = cell, {}, [], 0, 0
            if term is None:  # sorts first
                zero[g], size = p, n
                continue
            if not open_rows or open_rows[-1][0] != term:
                if terms == height:
                    yield from whole(False)
                    open_rows, terms = [], 0
                terms += 1
                seen += 1
            open_rows.append((term, g, n, p))
    if at is not None:
        yield from whole(True)


def report(spark: SparkSession, documents: DataFrame, **sizes: int) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: all pairs of a language's sources, and each group's ``TOP`` own terms."""
    audit = Audit(spark, documents, **sizes)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order)
    shown = ["lang", "source", "part", "item", "value", "rank"]
    pairs = audit.pairs().withColumn("rank", rank).withColumn("part", F.lit("pair")).select(*shown)
    terms = audit.terms().withColumn("rank", rank).where(F.col("rank") <= TOP).withColumn("part", F.lit("term")).select(*shown)
    return pairs.unionByName(terms)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
cell AS (
    SELECT g.lang, g.source, k.term, count(w.rid) AS n
    FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term GROUP BY 1, 2, 3
), sums AS (SELECT lang, source, sum(n) AS total FROM cell GROUP BY 1, 2),
p AS (
    SELECT c.lang, c.source, c.term, c.n, 1 + 1000000000::HUGEINT * (c.n + 5) // (s.total + 5 * z.v) AS p, 1 + 1000000000::HUGEINT * (k.n + 5) // (z.total + 5 * z.v) AS q
    FROM cell c JOIN sums s ON s.lang = c.lang AND s.source = c.source JOIN size z ON z.lang = c.lang JOIN kept k ON k.lang = c.lang AND k.term = c.term
), far AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 50
"""
