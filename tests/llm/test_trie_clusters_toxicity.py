"""Conversation tries, centroid clusters and toxic passages against versions
written from their contracts."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import cases
from cases import few_partitions  # noqa: F401 - applies to this module
from conftest import SMALL
from landfall.llm import centroid_clusters, conversation_trie, queries, toxic_passages
from landfall.llm.shingles import Powers

MEDIUM = SMALL.replace("0.001", "0.01")

# --- conversation trie ----------------------------------------------------


def expected_nodes(rows):
    """Node rows of (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            children[s[:-1]].add(s)
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, m in members.items():
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(m) - 1) * (len(s[-1][1]) if s else 0)
            leaves[s[:d]] += not children[s]
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(s))
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(children[s]), leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return cases.multiset(out)


def conversations():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 230), *range(-130, -90), 1005, 5_000_000_017]:
        kind = rng.randint(0, 3)
        for t in range(rng.randint(1, 9)):
            text = f"hello {t}" if t < 3 or kind == 0 else rng.choice(["a", "b", "cé \U0001F600", None, "", f"own {c}"])
            rows.append((c, t if rng.random() > 0.05 else None, rng.choice(["user", "user", "assistant", None]) if kind else "user", text))
    rows += [(None, 1, "user", "nobody's"), (7, 1, "user", "a tie"), (7, 1, "user", "a tie"), (7, 1, "user", "another"),
             (401, None, None, None), (9, 10**12, "user", "x" * 5000)]
    rows += [(2000 + i, t, "user", f"copied {t}") for i in range(60) for t in range(3)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, `key` string, n int, seq string, upper int, a long, node string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "s", 2, 3, "node") for r in rows], SCHEMA)


@pytest.mark.parametrize("large, shard_turns, pack", [(256, 4096, 1024), (3, 40, 7), (1, 1, 1)])
def test_trie_odd_rows(spark, monkeypatch, large, shard_turns, pack):
    """Shards that share upper nodes, and one shard for all, give equal rows."""
    for name, value in (("LARGE", large), ("SHARD_TURNS", shard_turns), ("PACK", pack)):
        monkeypatch.setattr(conversation_trie, name, value)
    rows = conversations()
    got = conversation_trie.prefix_trie(spark, frame(spark, rows)).collect()
    assert cases.multiset(got) == expected_nodes(rows)


def test_trie_empty_and_turnless(spark):
    assert conversation_trie.prefix_trie(spark, frame(spark, []).limit(0)).collect() == []
    # crc32 of these ids takes turns from an absent first conversation: none are left
    turnless = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6][:4]
    rows = [(c, 0, "user", "gone") for c in turnless]
    got = conversation_trie.prefix_trie(spark, frame(spark, rows)).collect()
    assert cases.multiset(got) == expected_nodes(rows) and len(got) == 1 and got[0]["n_leaves"] == 1


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert cases.multiset(queries.op11_conversation_trie(spark, MEDIUM).collect()) == expected_nodes(rows)


def test_double_array():
    """Every edge is found, nothing else is."""
    rng = random.Random(3)
    for _ in range(30):
        alphabet = rng.choice([1, 3, 50])
        words = sorted({tuple(rng.randrange(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 80))})
        offsets = np.append(0, np.cumsum([len(w) for w in words]))
        codes = np.array([c for w in words for c in w], np.int64)
        trie = conversation_trie.DoubleArray(*conversation_trie.trie_edges(codes, offsets, alphabet))
        prefixes = {w[:d] for w in words for d in range(len(w) + 1)}
        states = {(): 0}
        for p in sorted(prefixes, key=len):
            for c in range(alphabet):
                to = int(trie.child(np.array([states[p]]), np.array([c]))[0])
                assert (to >= 0) == ((*p, c) in prefixes)
                if to >= 0:
                    assert trie.check[to] == states[p]
                    states[(*p, c)] = to
        assert len(set(states.values())) == len(prefixes)


# --- centroid clusters ----------------------------------------------------


def expected_clusters(rows, k=40, rounds=5):
    kept = [(i, e) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    if not kept:
        return []
    limit = float(centroid_clusters.LIMIT)
    q = np.array([[max(min(int(np.floor(min(max(x, -limit), limit) * 256)), 1 << 26), -(1 << 26)) for x in e] for _, e in kept], object)
    key = [(i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest(), list(v)) for (i, _), v in zip(kept, q)]
    c = [list(q[j]) for j in sorted(range(len(kept)), key=key.__getitem__)[:k]]

    def assigned():
        d = np.stack([((q - np.array(p, object)) ** 2).sum(axis=1) for p in c], axis=1)
        best = [min(range(len(c)), key=lambda j: (row[j], j)) for row in d]
        return best, [int(row[j]) for row, j in zip(d, best)]

    for _ in range(rounds):
        own, _ = assigned()
        for j in set(own):
            mine = q[[i for i, o in enumerate(own) if o == j]]
            c[j] = [sum(column) // len(mine) for column in mine.T]
    own, distance = assigned()
    inertia = defaultdict(int)
    for o, d in zip(own, distance):
        inertia[o] += d
    top = (1 << 63) - 1
    return cases.multiset(
        (i, o, d, min(inertia[o], top), min(sum(distance), top), hashlib.sha256(",".join(map(str, c[o])).encode()).hexdigest())
        for (i, _), o, d in zip(kept, own, distance))


def vectors(rng, n, spread=0.1):
    centres = rng.normal(size=(5, 64))
    return [(i, (centres[i % 5] + spread * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(n)]


VECTORS = "vec_id long, embedding array<float>, label int, `own` int, point string, `order` string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, "p", "o") for i, e in rows], VECTORS)


def test_clusters_odd_rows(spark):
    rows = vectors(np.random.default_rng(1), 300)
    rows += [(None, rows[0][1]), (500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 63 + [None]), (504, [float("nan")] * 64),
             (505, [float("inf")] * 64), rows[3], rows[3], (3, rows[4][1]), (506, [0.0] * 64), (507, [-0.001] * 64)]
    got = centroid_clusters.clusters(spark, vector_frame(spark, rows)).collect()
    assert cases.multiset(got) == expected_clusters(rows)
    few = rows[:7] + [rows[2]]
    assert cases.multiset(centroid_clusters.clusters(spark, vector_frame(spark, few)).collect()) == expected_clusters(few)
    assert centroid_clusters.clusters(spark, vector_frame(spark, rows).limit(0)).collect() == []


def test_clusters_of_large_components(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(2).normal(size=(60, 64)) * 1e4)]
    rows += [(100, [1e30] * 64), (101, [-1e30] * 64)]
    got = centroid_clusters.clusters(spark, vector_frame(spark, rows)).collect()
    narrow = [(i, [float(np.float32(x)) for x in e]) for i, e in rows]
    assert cases.multiset(got) == expected_clusters(narrow)


def test_shallot_search_is_exact_and_skips():
    """Ties, equal centroids and moves: always the least (distance, number)."""
    rng = np.random.default_rng(4)
    searched = total = 0
    for trial in range(40):
        n, k = int(rng.integers(1, 200)), int(rng.integers(1, 20))
        wide = int(rng.integers(1, 30))
        x = rng.integers(-wide, wide, (n, 64))
        c = x[rng.integers(0, n, k)] if trial % 2 else rng.integers(-wide, wide, (k, 64))
        state = (np.full(n, -1), np.full(n, -1), np.zeros(n), np.zeros(n))
        before = None
        for _ in range(4):
            centroids = centroid_clusters.Centroids(c, before)
            values, points = centroid_clusters._exact(x, centroids)
            *state, looked = centroid_clusters.assign(values, points, centroids, *state)
            d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
            assert (state[0] == d.argmin(axis=1)).all()
            before, c = c, c + rng.integers(-1, 2, c.shape) * (rng.random((k, 1)) < 0.3)
            searched, total = searched + looked, total + n
    assert searched < total


def test_clusters_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert cases.multiset(queries.op13_centroid_clusters(spark, SMALL).collect()) == expected_clusters(rows)


# --- toxic passages -------------------------------------------------------


def expected_segments(scores):
    """Maximal scoring segments by their definition: the best contiguous
    segment (the shortest of equals, then the first), then the same left and
    right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > 0 and (best is None or (-s, b - a, a) < best[:3]):
                best = (-s, b - a, a, b)
    if best is None:
        return []
    a, b = best[2:]
    return (expected_segments(scores[:a]) + [(a, b, -best[0])]
            + [(x + b, y + b, s) for x, y, s in expected_segments(scores[b:])])


def test_maximal_segments():
    """Scores of different powers of two have no equal sums."""
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(0, 14)
        scores = [rng.choice([-1, 1]) * (rng.randint(1, 8) + 2.0 ** -(i + 4)) for i in range(n)]
        got = toxic_passages.maximal_segments(np.array(scores))
        assert [(a, b, round(s, 9)) for a, b, s in got] == [(a, b, round(s, 9)) for a, b, s in expected_segments(scores)]


def test_segment_scan_is_linear():
    scores = np.tile([1.0, -1.5, 2.0, -0.5], 100_000)
    assert len(toxic_passages.maximal_segments(scores)) >= 1


def test_tokens_do_not_depend_on_the_batch(monkeypatch):
    texts = ["One, two; ONE't\tétÉ 12a", "", "  ", "中文 x", "word" * 30 + " last"]
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    together = toxic_passages.tokens(np.frombuffer(b"".join(raw), np.uint8), offsets, Powers())
    monkeypatch.setattr(toxic_passages, "PIECE_BYTES", 4)
    for i, r in enumerate(raw):
        alone = toxic_passages.tokens(np.frombuffer(r, np.uint8), np.array([0, len(r)]), Powers())
        x, y = together[4][i], together[4][i + 1]
        assert (together[0][x:y] == alone[0]).all() and (together[1][x:y] == alone[1]).all()
        assert (together[2][x:y] - offsets[i] == alone[2]).all()
    assert together[0][0] == together[0][2] and len(set(together[1].tolist())) > 5


def test_extreme_value_fit():
    """K and L are found again in texts drawn from the law itself."""
    rng = np.random.default_rng(6)
    n = rng.integers(50, 3000, 20_000)
    best = np.log(0.02 * n / -np.log(rng.random(len(n)))) / 1.7
    c = toxic_passages.Calibration()
    c.fit_null(n, np.maximum(best, 0.0))
    assert abs(c.scale - 1.7) < 0.1 and abs(c.weight - 0.02) < 0.005


def test_toxicity_odd_rows(spark):
    df = cases.frame(spark)
    labels = spark.createDataFrame([(i, 0, i % 2, "t") for i in range(1, 25)] + [(7, 0, None, "t"), (None, 0, 1, "t"), (8, 0, 5, "t")],
                                   "doc_id long, quality int, toxic int, text string")
    got = toxic_passages.toxicity(spark, df, labels).collect()
    assert len(got) == df.count()
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 3, 100)}
    assert len(empty) == 1
    for r in got:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    for few in (labels.limit(0), labels.where("toxic = 1")):
        assert {r["score"] for r in toxic_passages.toxicity(spark, df, few).collect()} == {0.5}
    assert toxic_passages.toxicity(spark, df.limit(0), labels).collect() == []


def test_toxicity_finds_passages(spark):
    rng = random.Random(9)
    clean = [cases.sentence(rng, 60) for _ in range(150)]
    rows = []
    for i, t in enumerate(clean):
        words = t.split(" ")
        if i % 5 == 0:
            for _ in range(6):
                words.insert(rng.randint(20, 30), rng.choice(["zvile", "zfoul", "zrude"]))
        rows.append((i, "Ünï " + " ".join(words), i % 5 == 0))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxic_passages.toxicity(spark, docs, labels).collect()}
    assert np.mean([got[i]["predicted"] == x for i, _, x in rows]) > 0.98
    again = {r["doc_id"]: r["score"] for r in toxic_passages.toxicity(spark, docs.repartition(5), labels.repartition(3)).collect()}
    assert all(abs(again[i] - got[i]["score"]) < 1e-9 for i in got)
    for i, t, x in rows:
        if x:
            first = t.index("z")
            assert any(p["start"] <= first < p["stop"] for p in got[i]["passages"])


def test_toxicity_accuracy(spark):
    sf = SMALL.replace("0.001", "0.1")
    got = queries.op12_toxic_passages(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["toxic"] == r["predicted"] for r in got]) > 0.97
