"""Language-model scores from a subword lattice.

An existing subword vocabulary supplies the pieces, and its scores the first weights.
Expectation maximisation over all distinct training words fits the pieces' probabilities;
a word's lattice probability is the sum over all its segmentations into pieces
(forward recursion in log space). A piece never reaches over a word's begin, which is
marked, so a text's lattice is a chain of its words' lattices. Characters without a
piece are spelled in byte pieces.

A training word also is an arc of its own over the whole word: of its count c, c - d
goes to that arc, and what all words give up goes to the pieces (absolute discounting with the
lattice as the lower model; d = n1 / (n1 + 2 n2) from the numbers of words seen once and twice). ``score`` is the log of the marginal probability over all
segmentations with these arcs, ``lattice_score`` that of the pieces alone.

How it runs: words of all documents are counted (before and after one shuffle),
each distinct word's probability is computed once, a batch of words of one length at a
time, gathered over Arrow batches; a very long run is a word of its own lattice, walked in blocks. The ``HOT_WORDS`` most frequent words go to the tasks as a broadcast of bounded size;
what a document has beyond them is joined by word. Since no word outside the
broadcast is frequent, the join has no hot key, and nothing is left out.

Tokens: a text's maximal runs of bytes other than space and control white space (A-Z
lower-cased) and one end token. A null text is empty: the end token alone.
Repeated rows get the same result each. With no training document at all, counts are 0
and the vocabulary's own weights are used. Further columns aren't read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import textvec as V
from starmart.llm.common import fold, keep, mapped

HOT_WORDS = 150_000  # bound of the broadcast
ROUNDS = 2  # of expectation maximisation
SMOOTHING = 0.1
BATCH = 1 << 16  # characters of words of one length taken at a time
GATHER = 32_000  # words of several Arrow batches grouped by length at a time
GATHER_BYTES = 1 << 20
LONG = 400  # bytes; longer words are taken one by one
REACH = 1 << 15  # positions of a long word whose arcs are held at a time
MARK = 0x2581  # begins each word in the vocabulary
_FOREIGN = 0x110000  # the mark as a character of a text
_TO_LOWER = bytes(V.LOWER)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_LOWER).split()


class Pieces:
    """Vocabulary pieces in an open hash table over their code points."""

    BITS = 18

    def __init__(self, pieces: list[str], scores: list[float], end: str = "</s>"):
        self.names = pieces
        self.byte = np.full(256, -1, dtype=np.int64)
        self.end = pieces.index(end)
        usable, skip = [], {"<unk>", "<s>", "<pad>"}
        for i, p in enumerate(pieces):
            if len(p) == 6 and p.startswith("<0x") and p.endswith(">"):
                self.byte[int(p[3:5], 16)] = i
            elif p not in skip and i != self.end and p and all(ord(c) != MARK for c in p[1:]):
                usable.append(i)
        self.open = np.zeros(len(pieces), dtype=bool)  # pieces that can be generated
        self.open[usable] = self.open[self.byte[self.byte >= 0]] = True
        self.open[self.end] = True
        self.longest = max(len(pieces[i]) for i in usable)
        rng = np.random.default_rng(5)
        self.value = rng.integers(1, 1 << 63, size=1 << 12, dtype=np.uint64)
        self.keys = np.zeros(1 << self.BITS, dtype=np.uint64)
        self.slot = np.full(1 << self.BITS, -1, dtype=np.int32)
        self.single = np.zeros(_FOREIGN + 1, dtype=bool)  # characters that are pieces
        for i in usable:
            p = np.array([ord(c) for c in pieces[i]], dtype=np.int64)
            if len(p) == 1:
                self.single[p[0]] = True
            h = int(self.hashes(p[None, :])(0, len(p))[0])
            at = h >> (64 - self.BITS)
            while self.keys[at]:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.slot[at] = h, i
        self.taken = self.keys != 0
        # the vocabulary's scores fall with the rank of a piece
        w = np.where(self.open, 1 / (1 - np.minimum(scores, 0)), 0)
        self.start = np.log(np.where(w > 0, w, 1)) + np.where(w > 0, 0, -np.inf) - np.log(w.sum())

    def hashes(self, cp: np.ndarray):
        """Function (i, j) -> hashes of columns i..j-1 of a (words x length) code point matrix."""
        p, q = V._powers(cp.shape[1])
        v = self.value[cp & 0xFFF] * (cp.astype(np.uint64) * np.uint64(2) + np.uint64(1))
        s = np.zeros((cp.shape[1] + 1, cp.shape[0]), dtype=np.uint64)
        np.cumsum((v * p[: cp.shape[1]]).T, axis=0, out=s[1:])
        return lambda i, j: V.mix((s[j] - s[i]) * q[i]) | np.uint64(1)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, piece numbers) of the hashes that are pieces."""
        at = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        rows = np.flatnonzero(self.taken[at])
        at, h = at[rows], h[rows]
        out = np.full(len(rows), -1, dtype=np.int64)
        rest = np.arange(len(rows))
        while len(rest):
            k = self.keys[at[rest]]
            hit = k == h[rest]
            out[rest[hit]] = self.slot[at[rest[hit]]]
            rest = rest[~hit & (k != 0)]
            at[rest] = (at[rest] + 1) & ((1 << self.BITS) - 1)
        good = out >= 0
        return rows[good], out[good]

    def bytes_of(self, c: int) -> list[int]:
        return [int(self.byte[b]) for b in chr(MARK if c == _FOREIGN else c).encode()]


def load_pieces(path: str | None = None) -> Pieces:
    """Pieces and scores of a sentencepiece vocabulary file."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    n = sp.get_piece_size()
    return Pieces([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)])


def _batches(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, marked words as a code point matrix), a batch of words of one length at a time."""
    texts = [w.decode() for w in words]
    size = np.array([len(t) for t in texts])
    order = np.argsort(size, kind="stable")
    sizes = size[order]
    i = 0
    while i < len(order):
        n = int(sizes[i])
        j = min(int(np.searchsorted(sizes, n, side="right")), i + max(1, BATCH // (n + 1)))
        cp = np.frombuffer("".join([texts[k] for k in order[i:j].tolist()]).encode("utf-32-le"), dtype=np.uint32).astype(np.int64).reshape(j - i, n)
        cp = np.where(cp == MARK, _FOREIGN, cp)
        yield order[i:j], np.concatenate([np.full((j - i, 1), MARK), cp], axis=1)
        i = j


def _edges(pieces: Pieces, cp: np.ndarray, logp: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """For each end j the arcs (begin, rows, pieces, log weights); a spelled character has piece -2."""
    hashes = pieces.hashes(cp)
    n = cp.shape[1]
    out = []
    for j in range(1, n + 1):
        own = []
        for i in range(max(0, j - pieces.longest), j):
            rows, piece = pieces.find(hashes(i, j))
            w = logp[piece]
            if i == j - 1:
                odd = np.flatnonzero(~pieces.single[cp[:, i]])
                if len(odd):
                    rows, piece = np.append(rows, odd), np.append(piece, np.full(len(odd), -2))
                    w = np.append(w, [sum(logp[b] for b in pieces.bytes_of(int(c))) for c in cp[odd, i]])
            if len(rows):
                own.append((i, rows, piece, w))
        out.append(own)
    return out


def _logsum(n: int, terms: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log of the sums over (rows, log terms); -inf for a row without a term."""
    top = np.full(n, -np.inf)
    for rows, t in terms:
        top[rows] = np.maximum(top[rows], t)
    base = np.where(np.isfinite(top), top, 0)
    total = np.zeros(n)
    for rows, t in terms:
        total[rows] += np.exp(t - base[rows])
    with np.errstate(divide="ignore"):
        return base + np.log(total)


def _forward(edges: list, n: int) -> list[np.ndarray]:
    alpha = [np.zeros(n)]
    for own in edges:
        alpha.append(_logsum(n, [(rows, alpha[i][rows] + w) for i, rows, _, w in own]))
    return alpha


def gathered(batches: Iterator[pa.RecordBatch], column: str = "word") -> Iterator[pa.RecordBatch]:
    """Larger batches, so that words of one length come together; Arrow's own hold as few rows as whole texts allow."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch[column].nbytes
        if rows >= GATHER or size >= GATHER_BYTES:
            yield pa.concat_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.concat_batches(held)


class LongWord:
    """The lattice of one long word: arcs are found for a block of positions at a time, a piece length at a time."""

    def __init__(self, pieces: Pieces, word: bytes, logp: np.ndarray):
        cp = np.frombuffer(word.decode().encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        self.cp = np.concatenate([[MARK], np.where(cp == MARK, _FOREIGN, cp)])
        self.n, self.pieces, self.logp = len(self.cp), pieces, logp
        v = pieces.value[self.cp & 0xFFF] * (self.cp.astype(np.uint64) * np.uint64(2) + np.uint64(1))
        p, self.inverse = V._powers(self.n)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(v * p[: self.n], out=self.sums[1:])

    def blocks(self) -> list[int]:
        return list(range(0, self.n, REACH))

    def arcs(self, lo: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(end, begin, piece, log weight) of the arcs that end in lo+1..lo+REACH, by end; a spelled character has piece -2."""
        hi = min(self.n, lo + REACH)
        ends, begins, found = [], [], []
        for size in range(1, self.pieces.longest + 1):
            j = np.arange(max(lo + 1, size), hi + 1)
            i = j - size
            rows, piece = self.pieces.find(V.mix((self.sums[j] - self.sums[i]) * self.inverse[i]) | np.uint64(1))
            ends.append(j[rows])
            begins.append(i[rows])
            found.append(piece)
        weights = [self.logp[p] for p in found]
        at = np.arange(lo, hi)
        odd = at[~self.pieces.single[self.cp[at]]]
        if len(odd):
            kinds, which = np.unique(self.cp[odd], return_inverse=True)
            ends.append(odd + 1)
            begins.append(odd)
            found.append(np.full(len(odd), -2))
            weights.append(np.array([sum(self.logp[b] for b in self.pieces.bytes_of(int(c))) for c in kinds])[which])
        j = np.concatenate(ends)
        order = np.argsort(j, kind="stable")
        return j[order], np.concatenate(begins)[order], np.concatenate(found)[order], np.concatenate(weights)[order]

    def forward(self) -> np.ndarray:
        alpha = [-math.inf] * (self.n + 1)
        alpha[0] = 0.0
        for lo in self.blocks():
            j, i, _, w = self.arcs(lo)
            for end, begin, weight in zip(j.tolist(), i.tolist(), w.tolist()):
                alpha[end] = _added(alpha[end], alpha[begin] + weight)
        return np.array(alpha)

    def counts(self, times: float, total: np.ndarray) -> None:
        """Adds the expected use of each piece."""
        alpha = self.forward()
        beta = [-math.inf] * (self.n + 1)
        beta[self.n] = 0.0
        for lo in reversed(self.blocks()):
            j, i, piece, w = self.arcs(lo)
            for end, begin, weight in zip(j[::-1].tolist(), i[::-1].tolist(), w[::-1].tolist()):
                beta[begin] = _added(beta[begin], beta[end] + weight)
            first = int(j[0])
            share = np.exp(alpha[i] + w + np.array(beta[first : int(j[-1]) + 1])[j - first] - alpha[self.n]) * times
            own = piece >= 0
            total += np.bincount(piece[own], weights=share[own], minlength=len(total))
            if not own.all():
                kinds, which = np.unique(self.cp[i[~own]], return_inverse=True)
                for c, x in zip(kinds.tolist(), np.bincount(which, weights=share[~own]).tolist()):
                    for b in self.pieces.bytes_of(c):
                        total[b] += x


def _added(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _parted(words: list[bytes]) -> tuple[np.ndarray, list[int]]:
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return np.flatnonzero(size <= LONG), np.flatnonzero(size > LONG).tolist()


def word_logs(pieces: Pieces, words: list[bytes], logp: np.ndarray) -> np.ndarray:
    """Natural log of each word's marginal probability over all segmentations."""
    out = np.zeros(len(words))
    short, long = _parted(words)
    for at, cp in _batches([words[k] for k in short.tolist()] if long else words):
        out[short[at]] = _forward(_edges(pieces, cp, logp), len(at))[-1]
    for k in long:
        out[k] = LongWord(pieces, words[k], logp).forward()[-1]
    return out


def expected_counts(pieces: Pieces, words: list[bytes], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Expected use of each piece over all segmentations of the words (forward-backward)."""
    total = np.zeros(len(pieces.names))
    short, long = _parted(words)
    for k in long:
        LongWord(pieces, words[k], logp).counts(float(counts[k]), total)
    counts = counts[short]
    for at, cp in _batches([words[k] for k in short.tolist()] if long else words):
        edges = _edges(pieces, cp, logp)
        n, m = cp.shape[1], len(at)
        alpha = _forward(edges, m)
        out_of: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n + 1)]
        found, shares = [], []
        for j in range(n, 0, -1):
            beta = np.zeros(m) if j == n else _logsum(m, out_of[j])
            for i, rows, piece, w in edges[j - 1]:
                t = w + beta[rows]
                out_of[i].append((rows, t))
                share = np.exp(alpha[i][rows] + t - alpha[n][rows]) * counts[at[rows]]
                spelled = piece == -2
                if spelled.any():
                    for k in np.flatnonzero(spelled).tolist():
                        for b in pieces.bytes_of(int(cp[rows[k], i])):
                            total[b] += share[k]
                    piece, share = piece[~spelled], share[~spelled]
                found.append(piece)
                shares.append(share)
        if found:
            total += np.bincount(np.concatenate(found), weights=np.concatenate(shares), minlength=len(total))
    return total


def normalised(pieces: Pieces, counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the pieces from counts, with additive smoothing."""
    w = np.where(pieces.open, counts + SMOOTHING, 0)
    with np.errstate(divide="ignore"):
        return np.log(w / w.sum())


def word_counts(documents: DataFrame) -> DataFrame:
    """word (binary), c: its number in training texts; words of held-out texts alone have 0. Input: text, held."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text, held in zip(batch["text"].to_pylist(), batch["held"].to_pylist()):
                if held:
                    for w in set(split(text)):
                        counts.setdefault(w, 0)
                else:
                    counts.update(split(text))
                if len(counts) > 400_000:
                    yield _rows(counts)
                    counts = Counter()
        if counts:
            yield _rows(counts)

    return mapped(documents.select("text", "held"), task, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _rows(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])


def fit(spark: SparkSession, words: DataFrame, ends: float, pieces: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces by expectation maximisation over all training words, each
    counted once: the pieces stand in for rare words. ``ends``: the end piece's count."""
    logp = pieces.start
    sent = spark.sparkContext.broadcast(pieces)
    if ends == 0:
        return logp
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(logp)

        def task(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(sent.value.names))
            for batch in gathered(batches):
                total += expected_counts(sent.value, batch["word"].to_pylist(), np.ones(batch.num_rows), now.value)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["piece", "n"])

        got = mapped(words.where("c > 0"), task, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(len(pieces.names))
        for r in got:
            counts[r["piece"]] = r["n"]
        counts[pieces.end] = ends
        logp = normalised(pieces, counts)
        now.unpersist()
    return logp


def frequent(words: DataFrame, most: int) -> pa.Table:
    """The most frequent words, as many as fit: those of at least the smallest count class that ``most`` rows can hold."""
    level = F.floor(F.log2(F.col("c")) * 16)
    sizes = words.where("c > 0").groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).orderBy(F.desc("level")).collect()
    least, n = None, 0
    for r in sizes:
        n += r["n"]
        if n > most:
            break
        least = r["least"]
    return words.where(F.lit(False) if least is None else F.col("c") >= least).toArrow()


def score(spark: SparkSession, documents: DataFrame, pieces: Pieces | None = None, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score for each document (log10)."""
    pieces = pieces or load_pieces()
    docs = documents.select("doc_id", "text", (fold("doc_id", folds) == 0).alias("held"))
    words = keep(spark, word_counts(docs), "words")
    n_docs = docs.where(~F.col("held")).count()
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("n1"), F.count(F.when(F.col("c") == 2, 1)).alias("n2")).head()
    n_tokens, n_kinds = int(sums["n"]) + n_docs, int(sums["v"]) + (n_docs > 0)
    kinds, discount = int(sums["v"]), min(0.95, max(0.05, sums["n1"] / max(1, sums["n1"] + 2 * sums["n2"])))
    logp = fit(spark, words, n_docs * kinds / max(1, int(sums["n"])), pieces)
    sent, probs = spark.sparkContext.broadcast(pieces), spark.sparkContext.broadcast(logp)
    p = np.exp(logp)
    begins = sum(p[i] for i, x in enumerate(pieces.names) if pieces.open[i] and x.startswith(chr(MARK)))
    # share of the lattice's whole that are words and not the end
    lower = discount * kinds / max(1, n_tokens) * (begins + p[pieces.end]) / begins if kinds else 1.0

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            s = word_logs(sent.value, batch["word"].to_pylist(), probs.value)
            arc = np.maximum(batch["c"].to_numpy() - discount, 0) / max(1, n_tokens)
            with np.errstate(divide="ignore"):
                full = np.logaddexp(np.log(arc), np.log(lower) + s)
            yield pa.RecordBatch.from_arrays([batch["word"], batch["c"], pa.array(full / np.log(10)), pa.array(s / np.log(10))], names=["word", "c", "s", "t"])

    words = keep(spark, mapped(words, scored, "word binary, c long, s double, t double"), "word_scores")
    top = frequent(words, HOT_WORDS)
    hot = spark.sparkContext.broadcast(({w: k for k, w in enumerate(top["word"].to_pylist())}, top["c"].to_numpy().astype(float), np.stack([top["s"].to_numpy(), top["t"].to_numpy()], axis=1)))
    del top

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, c, s = hot.value
        logc = np.log10(c + SMOOTHING)
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                yield from _per_text(batch.slice(k, 2000), index, c, logc, s)

    marked = mapped(docs.withColumn("rid", F.monotonically_increasing_id()), texts, "rid long, doc_id long, held boolean, n_tokens long, known long, base double, score double, lattice double, word binary, tf long")
    marked = keep(spark, marked, "texts")
    cold = marked.where("word is not null").select("rid", "word", "tf").join(words, "word")
    rest = cold.groupBy("rid").agg(F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("k2"), F.sum(F.col("tf") * F.log10(F.col("c") + SMOOTHING)).alias("b2"), F.sum(F.col("tf") * F.col("s")).alias("s2"), F.sum(F.col("tf") * F.col("t")).alias("t2"))
    end_c, end_t = float(np.log10(n_docs + SMOOTHING)), float(logp[pieces.end] / np.log(10))
    end_s = float(np.log10(n_docs / n_tokens)) if n_docs else end_t
    per_token = float(np.log10(n_tokens + SMOOTHING * (n_kinds + 1)))
    zero = F.lit(0)
    return marked.where("word is null").join(rest, "rid", "left").select(
        "doc_id",
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("k2", zero) + F.lit(int(n_docs > 0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b2", zero) + F.lit(end_c) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        (F.col("score") + F.coalesce("s2", zero) + F.lit(end_s)).alias("score"),
        (F.col("lattice") + F.coalesce("t2", zero) + F.lit(end_t)).alias("lattice_score"),
    )


def _per_text(batch: pa.RecordBatch, index: dict, c: np.ndarray, logc: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each text with sums over its frequent words, and a row for each of its other words."""
    rids, n, known, base, sums = batch["rid"].to_pylist(), [], [], [], []
    cold_rid, cold_word, cold_tf = [], [], []
    for rid, text in zip(rids, batch["text"].to_pylist()):
        words = split(text)
        n.append(len(words) + 1)
        counts = Counter(words)
        at, tf = [], []
        for w, k in counts.items():
            i = index.get(w)
            if i is None:
                cold_rid.append(rid)
                cold_word.append(w)
                cold_tf.append(k)
            else:
                at.append(i)
                tf.append(k)
        at, tf = np.array(at, dtype=np.int64), np.array(tf, dtype=np.float64)
        known.append(int(tf[c[at] > 0].sum()))
        base.append(float(tf @ logc[at]))
        sums.append(tf @ s[at])
    names = ["rid", "doc_id", "held", "n_tokens", "known", "base", "score", "lattice", "word", "tf"]
    m = batch.num_rows
    yield pa.RecordBatch.from_arrays([batch["rid"], batch["doc_id"].cast(pa.int64()), batch["held"], pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array([float(x[0]) for x in sums], pa.float64()), pa.array([float(x[1]) for x in sums], pa.float64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64())], names=names)
    if cold_rid:
        m = len(cold_rid)
        yield pa.RecordBatch.from_arrays([pa.array(cold_rid, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.array(cold_word, pa.binary()), pa.array(cold_tf, pa.int64())], names=names)
