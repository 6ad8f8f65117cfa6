"""Operators on documents against brute force: odd rows and generated tables."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
import cases
from cases import few_partitions  # noqa: F401 - applies to this module
from conftest import SMALL, plan_text
from landfall.llm import byte_bpe, jaccard_join, mixing, queries, quality_rules, suffix_dedup
from landfall.llm.common import Scratch, components
from landfall.llm.shingles import Powers, shingle_sets


@pytest.fixture(scope="module")
def odd(spark):
    return cases.frame(spark).cache()


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]


# --- byte-level BPE -------------------------------------------------------

def expected_tokens(rows):
    enc = brute.tokenizer(*queries.bpe_files())
    return cases.multiset((i, *brute.tokens(enc, t)) for i, t, _ in rows)


def test_bpe_odd_rows(odd):
    assert cases.multiset(byte_bpe.digests(odd, *queries.bpe_files()).collect()) == expected_tokens(rows_of(odd))


def test_bpe_query(spark):
    got = queries.op3_byte_bpe(spark, SMALL)
    assert cases.multiset(got.collect()) == expected_tokens(
        rows_of(spark.read.parquet(f"{SMALL}/documents.parquet")))


def test_bpe_ids_round_trip(odd):
    files = queries.bpe_files()
    ids = byte_bpe.encode(odd.where("doc_id IS NOT NULL"), *files)
    back = {(r["doc_id"], bytes(r["bytes"])) for r in byte_bpe.decode(ids, *files).collect()}
    assert back == {(i, (t or "").encode()) for i, t, _ in rows_of(odd) if i is not None}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" \n\t'aZé5!中", min_size=0, max_size=120), st.integers(1, 9))
def test_bpe_pieces_keep_the_tokens(text, limit):
    enc = byte_bpe.encoding(*queries.bpe_files())
    pieces = list(byte_bpe.pieces(text, limit))
    assert "".join(pieces) == text
    assert [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab '\n\t\u3000\x85\x1c，字1_-s", max_size=60), st.integers(1, 9), st.integers(2, 5))
def test_bpe_runs_by_rule_keep_the_tokens(text, limit, run):
    """White space matched by rule, and all kinds of safe places."""
    enc, old = byte_bpe.encoding(*queries.bpe_files()), byte_bpe.LONG_RUN
    byte_bpe.LONG_RUN = run
    try:
        parts = list(byte_bpe._parts(text))
        ids = [i for part, is_match in parts for p in ([part] if is_match else byte_bpe.pieces(part, limit))
               for i in (enc._encode_single_piece(p) if is_match else enc.encode_ordinary(p))]
    finally:
        byte_bpe.LONG_RUN = old
    assert "".join(p for p, _ in parts) == text and ids == enc.encode_ordinary(text)


def test_bpe_very_long_runs(spark):
    """Runs that overflow the library's own pattern engine; the expected matches
    come from another one."""
    import public_tokenizers
    import regex

    files = queries.bpe_files()
    enc = byte_bpe.encoding(*files)
    mixed = " \n\t\u3000" * 300_000
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "x\n" + mixed + "\ny " + mixed, "中文字，" * 200_000, "字" * 300_000 + "\u3000" * 1_100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in byte_bpe.digests(df, *files).collect()}
    for i, text in enumerate(texts):
        ids = [t for m in regex.findall(public_tokenizers.PATTERN, text) for t in enc._encode_single_piece(m)]
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(text.encode()).hexdigest())
    assert max(len(p) for p in byte_bpe.pieces(texts[3])) < 2 * byte_bpe.PIECE_CHARS  # cut at its commas


def test_bpe_long_text(spark):
    rng = random.Random(3)
    text = cases.sentence(rng, 60_000) + "q" * 30_000 + " " * 5000 + "\n" * 500 + "end"
    assert len(list(byte_bpe.pieces(text))) > 3
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    enc = brute.tokenizer(*queries.bpe_files())
    assert [tuple(r) for r in byte_bpe.digests(df, *queries.bpe_files()).collect()] == [(1, *brute.tokens(enc, text))]


# --- mixing ---------------------------------------------------------------

def check_mix(got, rows):
    want = cases.multiset((d, n, s, round(t, 6), k) for d, n, s, t, k in brute.mix(rows))
    assert cases.multiset((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got) == want


def test_mix_odd_rows(odd, spark):
    with Scratch(spark, "t") as s:
        got = mixing.mix(s, odd).collect()
        again = mixing.mix(s, odd.repartition(5)).collect()
    check_mix(got, rows_of(odd))
    assert cases.multiset(got) == cases.multiset(again)
    assert all(r["taken"] <= 2 * r["size"] for r in got)


def test_mix_query_meets_targets(spark, small):
    got = queries.op10_source_mix(spark, SMALL).collect()
    check_mix(got, rows_of(small))
    source = {i: s for i, _, s in rows_of(small)}
    taken, target, largest = {}, {}, {}
    for r in got:
        s = source[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s], largest[s] = r["target"], max(largest.get(s, 0), r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in taken)


def test_mixed_documents_repeat_rows(odd, spark):
    out = mixing.mix_documents(spark, odd)
    assert out.columns == odd.columns
    got = cases.multiset((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    rows = rows_of(odd)
    want = [row for row, (_, n, _, _, taken) in zip(rows, brute.mix(rows), strict=True) if n for _ in range(taken // n)]
    assert got == cases.multiset(want)


# --- quality rules --------------------------------------------------------

def check_quality(got, rows):
    want = [(i, *[c[k] for k in quality_rules.COUNTS[:5]], failed, kept)
            for (i, _, _), (c, failed, kept) in zip(rows, brute.quality([t for _, t, _ in rows], quality_rules), strict=True)]
    assert cases.multiset(got) == cases.multiset(want)


def test_quality_odd_rows(odd, spark):
    check_quality(quality_rules.quality_rules(spark, odd).collect(), rows_of(odd))


def test_quality_query(spark, small):
    check_quality(queries.op9_quality_rules(spark, SMALL).collect(), rows_of(small))


def test_quality_keeps_labelled_good_documents(spark):
    sf = SMALL.replace("0.001", "0.01")
    got = queries.op9_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.where("NOT base_failed").select("quality", "kept").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in rows]) > 0.98


def test_quality_plan_is_native(spark, small):
    text = plan_text(quality_rules.counted(small, ["doc_id"]))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_quality_filter_keeps_columns(odd, spark):
    out = quality_rules.keep_good(spark, odd)
    assert out.columns == odd.columns
    rows = rows_of(odd)
    kept = [r for r, (_, _, k) in zip(rows, brute.quality([t for _, t, _ in rows], quality_rules), strict=True) if k]
    assert cases.multiset(rows_of(out)) == cases.multiset(kept)


# --- Jaccard join ---------------------------------------------------------

def expected_groups(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    groups = brute.jaccard_groups([t for _, t, _ in rows])
    return cases.multiset((rows[i][0], n, rows[low][0] if n else rows[i][0]) for i, (n, low) in enumerate(groups))


@pytest.mark.parametrize("rounds", [0, 2])
def test_jaccard_odd_rows(odd, spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", rounds)
    rng = random.Random(5)
    rows = rows_of(odd)
    base = cases.sentence(rng, 60).split(" ")
    for i in range(30):  # a chain of near copies, and a long shared passage
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = cases.sentence(rng, 1)
        base = w if i % 3 == 0 else base
        rows.append((200 + i, " ".join(w), "s"))
        rows.append((300 + i, " ".join(base[:30]) + " " + cases.sentence(rng, rng.randint(5, 40)), "s"))
    df = cases.frame(spark, [(i, t, None, s) for i, t, s in rows])
    assert cases.multiset(jaccard_join.jaccard_groups(spark, df).collect()) == expected_groups(rows)


def test_jaccard_query(spark, small):
    got = queries.op8_jaccard_join(spark, SMALL)
    assert cases.multiset(got.collect()) == expected_groups(rows_of(small))


def test_dealt_columns_hold_the_bound():
    n = np.arange(1, 1501)
    p, dealt = jaccard_join.first_columns(n)
    for a in n:
        b = n[(100 * np.minimum(a, n) >= jaccard_join.PERCENT * np.maximum(a, n))]
        least = -(-jaccard_join.PERCENT * (a + b) // (100 + jaccard_join.PERCENT))  # overlap of linked sets
        shared = np.minimum(dealt[a - 1] - (a - least), dealt[b - 1] - (b - least))
        assert (dealt[a - 1] - shared <= p[a - 1] - 1).all(), (a, b)


@pytest.mark.parametrize("rounds", [0, 1])
def test_jaccard_links_sets_of_5_and_4(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", rounds)
    rng = random.Random(8)
    texts = [cases.sentence(rng, 9, "abcdefghijklmnopqrstuvwxyz") for _ in range(12)]
    long = [(i, t, "s") for i, t in enumerate(texts)]
    short = [(100 + i, " ".join(t.split(" ")[i % 2:][:8]), "s") for i, t in enumerate(texts)]
    parts = [spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").coalesce(1)
             for rows in (long, short)]  # in different blocks
    got = jaccard_join.jaccard_groups(spark, parts[0].unionByName(parts[1])).collect()
    assert cases.multiset(got) == expected_groups(long + short)
    assert [r["component_id"] for r in got if r["doc_id"] >= 100] == [r["doc_id"] - 100 for r in got if r["doc_id"] >= 100]


@pytest.mark.parametrize("most", [2, 50])
def test_mix_of_crowded_keys(spark, monkeypatch, most):
    """Documents of weight 0.05 crowd into the last range: it is cut again until
    no task sorts more than SORTED of them."""
    rng = random.Random(8)
    monkeypatch.setattr(mixing, "SORTED", most)
    rows = [(i, " ".join("12345" for _ in range(rng.randint(1, 9))), "hot") for i in range(1500)]
    rows += [(5000 + i, "some words here", None) for i in range(100)] + [(None, "1 2 3", "hot")] * 40 + [(7, "9 9", "b")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    with Scratch(spark, "t") as scratch:
        kept, keep = [], scratch.keep
        scratch.keep = lambda d, tag, result=False: (kept.append((tag, keep(d, tag, result))), kept[-1][1])[1]
        assert cases.multiset(mixing.mix(scratch, df).collect()) == cases.multiset(brute.mix(rows))
        last = [d for tag, d in kept if tag == "mix-ends"][-1]
        assert all(r["n"] <= most or r["high"] == r["low"] for r in last.collect())


def test_one_of_each_group(odd, spark):
    """Exactly one row per component, also of rows with null or repeated ids."""
    rows = rows_of(odd)
    union = [low for _, low in brute.jaccard_groups([t for _, t, _ in rows])]
    first = {}
    for (i, _, _), group in zip(rows, union):
        order = (i is None, i or 0)
        first[group] = min(first.get(group, order), order)
    out = jaccard_join.one_of_each_group(spark, odd)
    assert out.columns == odd.columns
    got = rows_of(out)
    assert len(got) == len(first)
    assert sorted(((i is None, i or 0) for i, _, _ in got)) == sorted(first.values())
    assert set(got) <= set(rows)


def test_one_of_each_group_numbers_rows_by_place(spark, tmp_path):
    """Equal rows in one file and in several: one stays; clashing names."""
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (None, None), (1, "x y")],
                               "doc_id long, text string").selectExpr(
        "*", "1 AS key", "2 AS gone", "3 AS row", "4 AS gone_id", "5 AS file", "6 AS place", "7 AS `group`", "8 AS `order`")
    path = str(tmp_path / "docs")
    for _ in range(2):
        df.repartition(2).write.mode("append").parquet(path)
    out = jaccard_join.one_of_each_group(spark, spark.read.parquet(path))
    assert out.columns == df.columns
    assert cases.multiset(out.select("doc_id", "text").collect()) == cases.multiset(
        [(1, "a b c d e f"), (1, "x y")] + [(None, None)] * 4)


def test_heavy_shingles_are_bounded(spark, monkeypatch):
    """Whole levels of log2(count), never more than HEAVY shingles."""
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([2] * 50 + [5] * 20 + [40] * 7 + [1000] * 2)], "a long, b long")
    for most, want in ((3, 2), (8, 2), (9, 9), (30, 29), (100, 79), (1, 0)):
        monkeypatch.setattr(jaccard_join, "HEAVY", most)
        with Scratch(spark, "t") as scratch:
            keys, n = jaccard_join.heavy_shingles(scratch, counts)
        assert len(keys) == len(n) == want and (np.diff(keys.astype(np.int64)) > 0).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aAbB \n\té", max_size=40), min_size=1, max_size=6))
def test_shingle_sets_match_words(texts):
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    _, at, digest = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets, 5, Powers())
    sets = [brute.shingles(t) for t in texts]
    assert np.diff(at).tolist() == [len(s) for s in sets]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert (a == b) == (digest[i] == digest[j])


def test_long_rows_are_hashed_in_pieces(monkeypatch):
    from landfall.llm import shingles

    raw = (cases.sentence(random.Random(6), 400) + " " + "w" * 300 + "  \n tail words").encode()
    data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    whole = shingles.shingle_sets(data, offsets, 5, Powers())
    monkeypatch.setattr(shingles, "PIECE_BYTES", 50)
    pieces = shingles.shingle_sets(data, offsets, 5, Powers())
    assert all((a == b).all() for a, b in zip(whole, pieces, strict=True))


def test_components_match_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    union = brute.Union(range(200))
    for a, b in edges:
        union.join(a, b)
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    with Scratch(spark, "t") as s:
        got = {tuple(r) for r in components(s, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, union.find(x)) for x in nodes}


# --- suffix arrays --------------------------------------------------------

def expected_repeats(rows):
    texts = [t for _, t, _ in rows]
    return cases.multiset((i, len((t or "").encode()), removed, runs, hashlib.sha256(kept).hexdigest())
                          for (i, t, _), (kept, removed, runs) in zip(rows, brute.repeated(texts), strict=True))


@pytest.mark.parametrize("group", [512, 2])
def test_suffix_odd_rows(odd, spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(2)
    shared = cases.sentence(rng, 70)
    rows = rows_of(odd) + [(400 + i, cases.sentence(rng, rng.randint(0, 40)) + " " + shared[:rng.randint(150, 420)] + "|"
                            + cases.sentence(rng, rng.randint(1, 20)), "s") for i in range(25)]
    df = cases.frame(spark, [(i, t, None, s) for i, t, s in rows])
    assert cases.multiset(suffix_dedup.digests(spark, df).collect()) == expected_repeats(rows)


def test_suffix_query(spark, small):
    got = queries.op6_suffix_dedup(spark, SMALL)
    assert cases.multiset(got.collect()) == expected_repeats(rows_of(small))


def test_suffix_filter_keeps_columns(odd, spark):
    out = suffix_dedup.remove_repeats(spark, odd)
    assert out.columns == odd.columns
    rows = rows_of(odd)
    want = [(i, t if not removed else kept.decode("utf-8", "ignore"), s)
            for (i, t, s), (kept, removed, _) in zip(rows, brute.repeated([t for _, t, _ in rows]), strict=True)]
    assert cases.multiset(rows_of(out)) == cases.multiset(want)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())


def test_anchors_do_not_depend_on_slices(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    text = cases.sentence(rng, 3000).encode()
    whole = {int(a) for a in suffix_dedup.anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[1]}
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1 << 10)
    batch = pa.record_batch([pa.array([b"i"]), pa.array([text])], names=["text_id", "raw"])
    parts, windows = set(), 0
    for _, _, data, offsets, _ in suffix_dedup._row_slices(batch, 1):
        _, anchor, low, high = suffix_dedup.anchors(data, offsets)
        parts |= {int(a) for a in anchor}
        windows += int((high - low + 1).sum())
    assert parts == whole and windows == len(text) - suffix_dedup.WIDTH + 1


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 24), st.data())
def test_sorted_suffixes_and_prefixes(text, depth, data):
    x = np.frombuffer(text, np.uint8)
    places = np.array(sorted(data.draw(st.sets(st.integers(0, len(text) - 1), min_size=1))))
    order = suffix_dedup.sorted_suffixes(x, places, depth)
    assert sorted(order.tolist()) == places.tolist()
    heads = np.flatnonzero(np.append(True, np.diff(places) != 1))
    prefix = suffix_dedup.common_prefixes(x, order, places[heads], np.diff(np.append(heads, len(places))), depth)
    for i, at in enumerate(order.tolist()):
        shared = 0
        if i:
            a, b = text[order[i - 1]:][:depth], text[at:][:depth]
            assert a <= b
            while shared < min(len(a), len(b)) and a[shared] == b[shared]:
                shared += 1
        assert prefix[at] == shared


# --- empty tables ---------------------------------------------------------

@pytest.mark.parametrize("run", [
    lambda s, d: byte_bpe.digests(d, *queries.bpe_files()),
    quality_rules.quality_rules, quality_rules.keep_good, mixing.mix_documents,
    jaccard_join.jaccard_groups, jaccard_join.one_of_each_group, suffix_dedup.digests, suffix_dedup.remove_repeats,
], ids=["bpe", "quality", "keep_good", "mix", "jaccard", "one_of_each", "suffix", "remove"])
def test_empty_table(spark, odd, run):
    assert run(spark, odd.limit(0)).collect() == []
