"""Order-preserving packing of documents into training sequences.

Tasks take their documents in the order in which they come, as a stream of
token ids (each document's ids, then ``SEPARATOR``), in segments of whole
documents. For a segment, dynamic programming chooses the window cuts: they may
fall at a document's end (free), at a sentence's end or, where sentences are
long and in the segment's last window, inside a sentence (penalties, in tokens).
A window costs its padding: what is missing up to ``window`` tokens, or nothing
at a power of two. The best earlier cut for each position is the minimum of
cost + position over the last ``window`` tokens, which a monotone queue keeps,
so a segment takes time in proportion to its candidate cuts.

No shuffle takes place. A sequence number is the task's partition number and
a counter; for a file scan both come out the same when a task is repeated.

Defined results: a null or empty text is the separator alone. A repeated
document is packed each time. An empty table gives no piece. Ids, null ids and
further columns don't influence the packing.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import mapped
from starmart.llm.encode import encoder, vocabulary

WINDOW = 1024
SEPARATOR = 0
SEGMENT = 1 << 18  # tokens from which a segment of whole documents is closed
SENTENCE_CUT, HARD_CUT = 2, 12  # penalties in tokens
HARD_EVERY = 64  # inside a sentence, a cut is a candidate at every so many tokens


def choose_cuts(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The cheapest cuts among sorted candidate ``places`` (the first 0, the last the end; no gap
    over ``window``): indices of the chosen ones, both ends included."""
    n = len(places)
    where, pen = places.tolist(), penalty.tolist()
    # windows of exactly a power of two need no padding: the few pairs that allow it, by their later cut
    pairs_j, pairs_i = [], []
    p = 1
    while p < window:
        i = np.searchsorted(places, places - p)
        ok = np.flatnonzero((places >= p) & (places[np.minimum(i, n - 1)] == places - p))
        pairs_j.append(ok)
        pairs_i.append(i[ok])
        p *= 2
    js = np.concatenate(pairs_j) if pairs_j else np.zeros(0, np.int64)
    order = np.argsort(js, kind="stable")
    exact = np.concatenate(pairs_i)[order].tolist() if pairs_i else []
    upto = np.searchsorted(js[order], np.arange(n + 1)).tolist()
    cost, back = [0.0] * n, [0] * n
    queue = deque([(0.0, 0)])  # (cost + place, index), costs ascending
    left = 0  # the oldest candidate still within the window
    for j in range(1, n):
        at = where[j]
        while where[left] < at - window:
            left += 1
        while queue[0][1] < left:
            queue.popleft()
        best, i = queue[0]
        best += window - at
        for k in range(upto[j], upto[j + 1]):
            e = exact[k]
            if cost[e] < best:
                best, i = cost[e], e
        best += pen[j]
        cost[j], back[j] = best, i
        best += at
        while queue and queue[-1][0] >= best:
            queue.pop()
        queue.append((best, j))
    out, j = [n - 1], n - 1
    while j:
        j = back[j]
        out.append(j)
    return np.array(out[::-1])


def candidates(ids: np.ndarray, begin: np.ndarray, ends_sentence: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(places, penalties) for a segment whose documents begin at ``begin`` (its last entry: the end)."""
    total = int(begin[-1])
    pen = np.full(total + 1, np.inf)
    pen[HARD_EVERY::HARD_EVERY] = HARD_CUT
    pen[max(1, total - window) :] = HARD_CUT
    pen[1:][ends_sentence[ids]] = SENTENCE_CUT
    pen[begin] = 0
    if HARD_EVERY > window:
        pen[window::window] = np.minimum(pen[window::window], HARD_CUT)
    places = np.flatnonzero(np.isfinite(pen))
    return places, pen[places]


def pieces(ids: np.ndarray, begin: np.ndarray, ends_sentence: np.ndarray, window: int = WINDOW):
    """(document, start, length, sequence, offset) arrays and where each piece's ids begin."""
    places, pen = candidates(ids, begin, ends_sentence, window)
    cuts = places[choose_cuts(places, pen, window)]
    bounds = np.union1d(cuts, begin)
    at, end = bounds[:-1], bounds[1:]
    doc = np.searchsorted(begin, at, side="right") - 1
    seq = np.searchsorted(cuts, at, side="right") - 1
    return doc, at - begin[doc], end - at, seq, at - cuts[seq], at


def sentence_ends(enc) -> np.ndarray:
    """For each id, whether it ends a sentence: its text ends with a full stop, mark or line end."""
    n = enc.tok.get_vocab_size()
    out = np.zeros(n, dtype=bool)
    for i in range(n):
        t = (enc.tok.id_to_token(i) or "").rstrip("Ġ")
        out[i] = t.endswith((".", "!", "?", "Ċ"))  # Ċ: a line feed in byte-level BPE
    return out


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces: the id column, start, length, ids (binary: little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    path = path or vocabulary()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        ends = enc.__dict__.get("sentence_ends")
        if ends is None:
            ends = enc.sentence_ends = sentence_ends(enc)
        base = TaskContext.get().partitionId() << 36
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        n = made = 0

        def close():
            nonlocal made
            keys = pa.concat_arrays([h[0] for h in held])
            ids = np.concatenate([h[1] for h in held])
            begin = np.append(0, np.cumsum(np.concatenate([h[2] for h in held])))
            doc, start, length, seq, offset, at = pieces(ids, begin, ends, window)
            data = ids.astype("<u4")
            bounds = pa.array(np.append(at, len(ids)) * 4, pa.int32())
            binary = pa.Array.from_buffers(pa.binary(), len(at), [None, bounds.buffers()[1], pa.py_buffer(data)])
            out = [keys.take(pa.array(doc)), pa.array(start), pa.array(length), binary, pa.array(np.diff(begin)[doc]), pa.array(base + made + seq), pa.array(offset)]
            made += int(seq[-1]) + 1
            for k in range(0, len(at), 4096):
                yield pa.RecordBatch.from_arrays([x.slice(k, 4096) for x in out], names=["__id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for i, j, ids, begin in enc.encode(batch[text_col]):
                with_end = np.insert(ids, begin[1:], SEPARATOR)
                held.append((batch["__id"].slice(i, j - i), with_end, np.diff(begin) + 1))
                n += len(with_end)
                if n >= SEGMENT:
                    yield from close()
                    held, n = [], 0
        if held:
            yield from close()

    kind = documents.schema[id_col].dataType.simpleString()
    out = mapped(documents.select(F.col(id_col).alias("__id"), F.col(text_col)), task, f"__id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("__id", id_col)


def report(documents: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(documents, path=path).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
