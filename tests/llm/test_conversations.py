import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F, types as T

from tallyframe.llm import conversations

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])


def plain(rows):
    """Rebuild every conversation and walk its prefixes."""
    def last(role, text):
        return hashlib.sha256(b"%d:%s%s" % (len(role.encode()), role.encode(), text.encode())).digest()

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", last(role or "", text or ""), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(c - rest, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def answer(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("clash")).withColumn(
        "digest", F.lit(2)).withColumn("owner", F.lit(3))
    return sorted((tuple(r) for r in conversations.report(table, **options).collect()), key=str)


def talks(seed, convs=40, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.15:
            continue  # some bases are missing
        for t in range(rng.randrange(1, 13)):
            rows.append((c, t, rng.choice(["user", "tool"]), rng.choice(["a", "bé", "", "long one"][:words])))
    return rows


EDGE = [
    (7, None, None, None), (7, None, None, None), (7, 0, "user", "x"), (7, 0, "user", "x"),
    (None, 1, "user", "lost"), (-3, 1, "user", "x"), (-5, 2, "user", "y"), (-5, 1, None, "x"),
    (6, 0, "user", ""), (5, 0, "user", "z" * 200_000), (8, 0, "user", "z" * 200_000), (9, 3, "", "q"),
]


def test_nodes_match_brute_force(spark):
    for seed, words in [(1, 1), (2, 2), (3, 4)]:
        rows = talks(seed, words=words)
        assert answer(spark, rows) == plain(rows)


def test_copies_own_nothing(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 200, 5) for t in range(12)]
    got = answer(spark, rows)
    assert got == plain(rows)
    assert all(r[3] == 40 and r[5] == 1 for r in got)


def test_nulls_ties_repeats_and_negative_ids(spark):
    assert answer(spark, EDGE) == plain(EDGE)


def test_no_conversations(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(None, 1, "user", "x")]) == []


def test_a_long_conversation_is_scanned_in_slices(spark, monkeypatch):
    monkeypatch.setattr(conversations, "slice_count", lambda df, rows, size: 7)
    rows = [(5, t, "user", f"turn {t % 11}") for t in range(400)]
    rows += [(c, t, "user", f"turn {t % 11}") for c in (3, 6, 7, 8) for t in range(30)]
    assert answer(spark, rows) == plain(rows)


def test_many_ends_of_one_node_are_packed(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PACK_BYTES", 16)
    rows = [(c, 0, "user", "x") for c in range(0, 300, 5)] + talks(9)
    rows = [(c, t, r, x) for c, t, r, x in rows if not (r == "user" and x != "x" and c % 5 == 0)]
    assert answer(spark, rows) == plain(rows)


def test_a_weak_fingerprint_is_found_out_and_replaced(spark):
    rows = talks(4, words=4)
    table = spark.createDataFrame(rows, SCHEMA)
    trie = conversations.build(table, strengths=((256, 3), (512, 127)))
    assert trie.attempts == 2
    assert answer(spark, rows, strengths=((256, 3), (512, 127))) == plain(rows)


def test_fingerprints_compose():
    ring = conversations.Ring(127)
    parts = [(1, 5), (1, 9), (1, 2**126)]
    left = ring.compose(ring.compose(parts[0], parts[1]), parts[2])
    assert left == ring.compose(parts[0], ring.compose(parts[1], parts[2]))
    assert ring.without_head(parts[0], left) == ring.compose(parts[1], parts[2])
    assert ring.compose((0, 0), left) == left == ring.compose(left, (0, 0))
