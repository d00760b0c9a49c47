"""Conversation trie against a plain dictionary of beginnings."""

import hashlib
import random
import zlib

from llm_data import rows_of

from starmart.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, path string, n_convs double"


def plain(rows):
    """Nodes of the rebuilt conversations, beginning by beginning."""
    own = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", hashlib.sha256((x or "").encode()).digest(), x or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - int(abs(c) % 100) * (1 if c >= 0 else -1), [])
        built[c] = tuple(base[:h] + v[h:])
    nodes = {}
    for c, p in built.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q)
        leaves = sum(1 for q in below if not any(z[: len(q)] == q and len(z) == len(q) + 1 for z in below))
        end = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids), leaves, saved, hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 215), -3, -100, -150]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["", "ja", "nein 日本", "x" * 40]), "p", 1.0))
    rows += [(c, t, "user", f"copy {t}", "p", 1.0) for c in range(300, 345) for t in range(3)]  # a hot group of copies
    rows += [(None, 0, "user", "lost", "p", 1.0), (500, None, None, None, None, None), (500, None, "a", "b", None, None), (500, 1, None, "b", None, None), (500, 1, None, "b", None, None)]
    rows += [(501, t, "user", f"long {t}", "p", 1.0) for t in range(12)] + [(502, 0, "user", "é" * 200_000, "p", 1.0)]
    rng.shuffle(rows)
    return rows


def found(spark, rows, **sizes):
    convs = T.rebuilt(T.turns_of(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    return sorted(rows_of(T.trie(spark, convs, **sizes)), key=str)


def test_awkward_conversations_against_brute_force(spark):
    rows = conversations()
    want = plain(rows)
    assert found(spark, rows) == want
    # ids hashed from chunks of two, parents joined by shuffle
    assert found(spark, rows, hot_parents=1, chunk=2) == want


def test_no_conversation(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x", "p", 1.0)]) == []


def test_turnless_conversation_ends_at_the_root(spark):
    rows = [(c, 0, "user", f"t{c}", "p", 1.0) for c in (101, 102, 103, 104)]  # no conversation 100: those with h > 0 lose their turn
    assert found(spark, rows) == plain(rows)
    assert any(r[1] == 0 and r[7] != T.EMPTY for r in plain(rows))


def test_long_conversations_add_no_rounds(spark):
    rows = [(c, t, "user", f"{c if t > 2 else 0} {t}", "p", 1.0) for c in (7, 8, 9) for t in range(500)] + [(900 + c, t, "user", f"twin {t}", "p", 1.0) for c in range(3) for t in range(300)]
    convs = T.turns_of(spark.createDataFrame(rows, SCHEMA))
    sequences = convs.groupBy("path").agg(T.F.count(T.F.lit(1)).alias("n_convs"), T.F.min("conv_id").alias("conv_id"))
    levels = T.peel(spark, sequences.join(T.private_from(sequences), "conv_id", "left"))
    assert len(levels) <= 4
    nodes = {(r.conv_id, r.depth): r for r in T.trie(spark, convs).collect()}
    assert len(nodes) == 1 + 3 + 3 * 497 + 300
    assert nodes[7, 0].n_leaves == 4 and nodes[7, 3].n_children == 3 and nodes[8, 4].parent_conv_id == 7 and nodes[8, 500].parent_conv_id == 8
    assert nodes[900, 1].saved_tokens == 2 * sum(len(f"twin {t}") for t in range(300)) and nodes[900, 1].parent_conv_id == 7
    assert nodes[900, 300].ends_sha256 == hashlib.sha256(b"900,901,902").hexdigest() and nodes[900, 299].ends_sha256 == T.EMPTY
