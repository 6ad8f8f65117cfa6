"""Pages, embeddings and fitted models: brute force, round trips, accuracy."""

import base64
import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest

import brute
import cases
from cases import few_partitions  # noqa: F401 - applies to this module
from conftest import SMALL
from landfall.llm import embedding_dedup, html_text, language_id, line_crf, queries, warc
from landfall.llm.common import Scratch

# --- WARC -----------------------------------------------------------------


def expected_records(rows):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    first = {}
    for i, _, html in rows:
        key = (html or "").encode()
        if i is not None:
            first[key] = min(first.get(key, i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        low = first.get(raw)
        again = low is not None and i != low
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", low if again else None))
    return cases.multiset(out)


PAGES = [(5, "http://a/ b\r\nX: y", "x" * 1000), (3, None, "x" * 1000), (None, "u", "x" * 1000), (7, "u", None),
         (8, "", ""), (5, "z", "x" * 1000), (9, "http://é/", "<p>é\r\n\r\nWARC/1.1\r\n"), (10, "u", "y" * 300_000),
         (3, None, "x" * 1000)] + [(100 + i, f"http://h{i % 3}/", f"<html><p>text {i} {'pad ' * i}</p></html>") for i in range(40)]


def test_warc_odd_rows(spark):
    df = spark.createDataFrame([(*r, "p", 1) for r in PAGES], "page_id long, url string, html string, payload string, sha1 int")
    assert cases.multiset(warc.round_trip(spark, df).collect()) == expected_records(PAGES)
    assert warc.round_trip(spark, df.limit(0)).collect() == []


def test_warc_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()
    assert cases.multiset(queries.op2_warc(spark, SMALL).collect()) == expected_records([tuple(r) for r in pages])


def test_warc_archive_format(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 18)
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    with Scratch(spark, "t") as s:
        path = s.path("archives")
        s.temporary(path)
        warc.write_archives(s, df, path)
        back = warc.read_archives(spark, path).collect()
        files = [bytes(r["content"]) for r in spark.read.format("binaryFile").option(
            "pathGlobFilter", "part-*").load(path).collect()]
    payloads = Counter((r["page_id"], bytes(r["payload"])) for r in back if r["kind"] == "response")
    kinds = expected_records(PAGES)
    assert sum(payloads.values()) == sum(k[3] == "response" for k in kinds)
    assert (10, b"y" * 300_000) in payloads and (9, PAGES[6][2].encode()) in payloads
    full = [f for f in files if f]
    assert all(f[:4] == warc.DICTIONARY_MAGIC.to_bytes(4, "little") for f in full)
    assert any(int.from_bytes(f[4:8], "little") for f in full)  # a dictionary was trained
    with pytest.raises(ValueError):
        list(warc.read_archive(max(full, key=len)[:-9]))


def test_warc_every_archive_has_a_dictionary(monkeypatch):
    """Few records, large ones, tiny ones, uniform ones; several segments."""
    rng = random.Random(4)
    large = [("".join(rng.choice("abcdef ") for _ in range(200_000))).encode() for _ in range(3)]
    for records in (large, [b"x"], [b"tiny %d" % i for i in range(5)], [b"\x00" * 100_000], [b"same"] * 100):
        data = list(warc.frames(records))
        assert int.from_bytes(data[0][4:8], "little") > 0 and list(warc.read_archive(b"".join(data))) == records
    late = [b"a" * 3000 + bytes([i]) for i in range(40)] + [b"the only common passage of late records " * 40 + bytes([i]) for i in range(40)]
    assert any(b"only common" in p for p in warc.training_pieces(late))
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 300_000)
    data = list(warc.frames(large * 2))
    assert sum(f[:4] == warc.DICTIONARY_MAGIC.to_bytes(4, "little") for f in data) == 3
    assert list(warc.read_archive(b"".join(data))) == large * 2
    assert list(warc.frames([])) == []


def test_warc_repeated_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 18)
    df = spark.range(3000).selectExpr("7L AS page_id", "'u' AS url", "repeat('<p>page', 50) AS html").repartition(16)
    with Scratch(spark, "t") as s:
        path = s.path("archives")
        s.temporary(path)
        warc.write_archives(s, df, path)
        rows = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
        sizes = [len(list(warc.read_archive(bytes(r["content"])))) for r in rows if r["content"]]
    assert sum(sizes) == 3000 and max(sizes) < 2000 and len(sizes) > 1


# --- HTML -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><div class="site-header"><h1>Site</h1></div>
<ul class="menu"><li><a href=x>One</a></ul><div class="cookie-notice">We use cookies</div>
<div class="post post-%d"><h2>Ti &amp; tle</h2><p>Hello   <i>wor</i>ld &lt;b&gt;<p>Second &eacute;<br>para <span class="ad">BUY</span> end
<script>var t="</p>";</script><table><tr><td>a<td>b<tr><td>c</table><ul><li>x<li>y</ul>
<div class=comments><p>nice post, much longer than the article itself, really very much longer</div>
<form><input value=">">Email</form></div><aside>side text here</aside><footer>f</footer>"""
MAIN = "Ti & tle\n\nHello world <b>\n\nSecond é para end\n\na b\n\nc\n\nx\n\ny"


def test_html_odd_rows(spark):
    rows = [(1, "http://h/1", PAGE % 17), (2, "http://H/2", PAGE % 4711), (3, "http://h/3", None), (4, None, ""),
            (5, "odd", "plain < 5 &amp; more <p>para"), (None, "http://h/6", "<div>only this</div>"),
            (1, "http://h/1", PAGE % 17), (7, "http://g/", "<a " * 2000), (8, "http://g/", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame([(*r, "host") for r in rows], "page_id long, url string, html string, host string")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_text.main_text(spark, df).collect()}
    want = {(1, "http://h/1"): MAIN, (2, "http://H/2"): MAIN, (3, "http://h/3"): "", (4, None): "",
            (5, "odd"): "plain < 5 & more\n\npara", (None, "http://h/6"): "only this", (8, "http://g/"): "deep"}
    for key, text in want.items():
        assert got[key] == (text, len(text)), key
    assert html_text.main_text(spark, df).count() == len(rows)
    assert html_text.main_text(spark, df.limit(0)).collect() == []


@pytest.mark.parametrize("extra", [
    '<div class="sidebar left">no</div>', '<div id="cookieBanner">no</div>', '<section id="comments"><p>no</section>',
    '<div class="ad1">no</div>', '<div role="navigation">no</div>', '<header>no</header>', '<div class="header">no</div>',
    '<div class="site-header">no</div>', '<nav>no</nav>', '<aside>no</aside>', '<form>no <p>no</form>', '<!-- no -->',
    '<noscript>no</noscript>', '<p class="notice">no</p>', '<ol class="commentlist"><li>no</ol>', '<style>no</style>',
    '<select><option>no</select>', '<template>no</template>', '<button>no</button>'])
def test_what_is_no_article_goes(extra):
    page = '<body>{0}<div class="post"><h1>Title</h1><p>Some words of text.</p>{1}<p>More of them, too.</p></div>{0}'
    want = "Title\n\nSome words of text.\n\nMore of them, too."
    assert html_text.extract(page.format(extra, ""), None) == want
    if "header" not in extra:
        assert html_text.extract(page.format("", extra), None) == want


@pytest.mark.parametrize("block", [
    '<section class="related-work"><p>kept</p></section>', '<table class="share-prices"><tr><td>kept</table>',
    '<p class="side-effects">kept</p>', '<div id="searchResults"><p>kept</p></div>', '<p class="comment-on-method">kept <a href=x>x</a></p>',
    '<div class="footnotes">kept</div>'])
def test_names_of_an_article_stay(block):
    page = f'<nav>no</nav><article><h1>Title</h1><p>Some words of text.</p>{block}<p>More of them, too.</p></article>'
    got = html_text.extract(page, None).split("\n\n")
    assert len(got) == 4 and got[2].startswith("kept")


@pytest.mark.parametrize("block", [
    '<div class="share-buttons">no</div>', '<div class="related-posts"><a href=x>no</a></div>', '<p class="notice">no</p>',
    '<div class="ad">no</div>', '<div id="cookieBanner">no</div>', '<ul class="related-reading"><li><a href=x>no no no</a></ul>',
    '<aside>no</aside>', '<section class="comments"><p>no</section>', '<div class="newsletter-signup">no</div>',
    '<p>yes <span class="ad-slot">no</span></p>', '<div class="comment-list"><article class=comment>no</article></div>'])
def test_furniture_in_an_article_goes(block):
    page = f'<nav>no</nav><article><h1>Title</h1><p>Some words of text.</p>{block}<p>More of them, too.</p></article>'
    got = html_text.extract(page, None)
    assert "no" not in got.split() and got.startswith("Title\n\nSome words of text.") and got.endswith("More of them, too.")


def test_stray_end_tags_and_depth():
    import time

    start = time.time()
    html_text.parse("<div>" * 50_000 + "</section>" * 50_000 + "text")
    assert time.time() - start < 8  # linear; quadratic took minutes
    inner = '<article><p>The article itself has some words.</p></article><div class="teaser"><a href=x>Next story link</a></div>'
    assert html_text.extract("<div>" * 70 + inner + "</div>" * 70, None) == "The article itself has some words."
    assert html_text.extract(inner, None) == "The article itself has some words."


def test_votes_match_brute_force(spark):
    """The path of each host is the one most of its pages vote for."""
    rng = random.Random(12)
    rows = [(i, f"http://h{rng.randint(0, 4)}/{i}", f'<div class="{rng.choice("xyz")}{i}"><p>{"word " * rng.randint(1, 40)}</p></div>'
             f'<div class="{rng.choice("xyz")}"><p>{"other " * rng.randint(1, 40)}</p></div>') for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark, df).collect()}
    counts = defaultdict(lambda: defaultdict(lambda: [0, 0.0]))
    for _, url, html in rows:
        path, score = html_text.best_path(html)
        counts[url.split("/")[2]][path][0] += 1
        counts[url.split("/")[2]][path][1] += score
    for i, url, html in rows:
        votes = counts[url.split("/")[2]]
        best = min(votes, key=lambda p: (-votes[p][0], -votes[p][1], p))
        assert got[i] == html_text.extract(html, best)


@pytest.mark.parametrize("tag", sorted(html_text._RAW))
def test_raw_ends_are_found_after_letters_that_grow(tag):
    first = "\u0130stanbul " * 20 + "first paragraph of the article"  # U+0130 is two characters in lower case
    page = (f"<html><body><article><p>{first}</p><{tag}>gone</{tag.upper()}><p>Second paragraph</p>"
            f"<{tag}>gone</{tag}><p>Third paragraph</p></article></body></html>")
    assert html_text.extract(page, None) == f"{first}\n\nSecond paragraph\n\nThird paragraph"


def test_host_consensus_decides(spark):
    """A page whose longest container is not the host's article follows the host."""
    usual = '<body><div class="x"><p>%s</p></div><div class="y"><p>%s</p></div>'
    rows = [(i, "http://h/", usual % ("article words " * 20, "rest " * 3)) for i in range(5)]
    rows.append((9, "http://h/", usual % ("short article", "longer other text " * 30)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark, df).collect()}
    assert got[9] == "short article" and got[0] == ("article words " * 20).strip()


def test_html_query_gives_the_articles(spark):
    import re

    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in queries.op5_html_text(spark, SMALL).collect()}
    assert len(got) == len(pages)
    for r in pages:
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(unescape(x.replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>|<b>", article)]
        assert got[r["page_id"]] == "\n\n".join(x for x in blocks if x)


# --- embeddings -----------------------------------------------------------

def brute_vectors(rows):
    """(vec_id, n_links, component_id, kept) of (vec_id, vector, label)."""
    groups = defaultdict(list)
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            groups[label, len(v)].append(i)
    links, union = [0] * len(rows), brute.Union(range(len(rows)))
    for members in groups.values():
        for a, b in itertools.combinations(members, 2):
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[a] += 1
                links[b] += 1
                union.join(a, b)
    low = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            root = union.find(i)
            low[root] = min(low.get(root, v), v)
    return cases.multiset((v, links[i], low.get(union.find(i)), v == low.get(union.find(i)))
                          for i, (v, _, _) in enumerate(rows))


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2):
        centre = rng.normal(size=24)
        for i in range(60):
            spread = rng.choice([0.05, 0.13, 0.2, 2.0])
            rows.append((len(rows), (centre + spread * rng.normal(size=24)).tolist(), label))
    rows += [(500 + i, rows[3][1], 1) for i in range(6)] + [(3, rows[3][1], 1)]
    rows += [(600, [0.0] * 24, 1), (601, None, 1), (602, [1.0, None], 1), (603, [float("nan"), 1.0], 1),
             (604, [float("inf"), 0.0], 1), (605, [1.0, 0.0], None), (606, [], 1), (607, [1.0, 0.0], 1),
             (608, [1.0, 0.001], 1), (609, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.002], 1), (None, [0.0, 1.0], 1)]
    return rows


@pytest.mark.parametrize("tile", [1024, 16])
def test_embeddings_odd_rows(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = vectors()
    df = spark.createDataFrame([(*r, "n", 1) for r in rows],
                               "vec_id long, embedding array<double>, label int, n string, tile int")
    assert cases.multiset(embedding_dedup.near_duplicates(spark, df).collect()) == brute_vectors(rows)
    assert embedding_dedup.near_duplicates(spark, df.limit(0)).collect() == []


def test_embeddings_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"])
            for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert cases.multiset(queries.op4_embedding_dedup(spark, SMALL).collect()) == brute_vectors(rows)


def test_tile_links_at_the_threshold():
    """Pairs around the threshold are decided by doubles, whatever the bounds."""
    rng = np.random.default_rng(9)
    for width in (3, 64, 1500):
        x = rng.normal(size=(40, width))
        noise = rng.normal(size=(40, width))
        y = x + noise * (np.linalg.norm(x, axis=1) / np.linalg.norm(noise, axis=1) * rng.uniform(0.19, 0.215, 40))[:, None]
        exact = np.array([[embedding_dedup.cosines(a[None], b[None])[0] for b in y] for a in x]) >= 0.98
        assert (embedding_dedup.tile_links(x, y) == exact).all()


# --- language identification ----------------------------------------------

def ppm_counts(texts):
    out = defaultdict(Counter)
    for t in texts:
        raw = b"\n" * 3 + t.encode()
        for i in range(3, len(raw)):
            for k in range(4):
                out[raw[i - k:i]][raw[i]] += 1
    return out


def ppm_bits(counts, text):
    raw, total = b"\n" * 3 + text.encode(), 0.0
    for i in range(3, len(raw)):
        for k in (3, 2, 1, 0):
            seen = counts.get(raw[i - k:i])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                if raw[i] in seen:
                    total += math.log2((n + kinds) / seen[raw[i]])
                    break
                total += math.log2((n + kinds) / kinds)
        else:
            total += 8
    return total


def test_ppm_code_lengths(spark, monkeypatch):
    corpus = [("aa", "hello world"), ("aa", "hallo welt é"), ("bb", "bonjour le monde"), ("bb", "salut")]
    df = spark.createDataFrame([(lang, t.encode()) for lang, t in corpus], "lang string, raw binary")
    table = language_id.gram_counts(df).toArrow()
    langs = ["aa", "bb"]
    trees = language_id.ContextTrees(langs, np.array([langs.index(x) for x in table.column("lang").to_pylist()]),
                                     table.column("gram").to_numpy(), table.column("n").to_numpy())
    tests = ["hello", "bon monde", "xyz é", "", "\n\n\nle", "worélt hallo zz"]
    raw = [t.encode() for t in tests]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
    want = [[ppm_bits(ppm_counts([t for x, t in corpus if x == lang]), t) for lang in langs] for t in tests]
    assert np.allclose(language_id.row_code_lengths(trees, data, offsets), want)
    monkeypatch.setattr(language_id, "SLICE_BYTES", 5)  # pieces of long rows add up
    assert np.allclose(language_id.row_code_lengths(trees, data, offsets), want)
    monkeypatch.setattr(language_id, "DENSE", 1)        # searched instead of looked up
    trees = language_id.ContextTrees(langs, np.array([langs.index(x) for x in table.column("lang").to_pylist()]),
                                     table.column("gram").to_numpy(), table.column("n").to_numpy())
    assert np.allclose(language_id.row_code_lengths(trees, data, offsets), want)


def test_language_odd_rows(spark):
    df = cases.frame(spark)
    got = language_id.identify(spark, df).collect()
    assert len(got) == df.count()
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    for r in got:
        assert 0.0 <= r["score"] <= 1.0 and r["lang_pred"] in ("aa", "bb", "und")
        if r["doc_id"] is not None:
            letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == (not letters)
        else:
            assert not r["held_out"]
    assert language_id.identify(spark, df.limit(0)).collect() == []
    nothing = language_id.identify(spark, df.withColumn("lang", df["lang"].substr(9, 1)).where("lang IS NULL"))
    assert {r["lang_pred"] for r in nothing.collect()} <= {"und"}


def test_long_texts_and_copies_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_BYTES", 1 << 16)
    rng = random.Random(9)
    rows = [(i, cases.sentence(rng, 100_000, "abcdefgh"), "aa") for i in range(4)]    # few and very long
    rows += [(100 + i, cases.sentence(rng, 600, "stuvwxyz"), "bb") for i in range(60)]
    rows += [(1000 + i, rows[-1][1], "bb") for i in range(3000)]                      # mostly copies
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = [(r["lang"], bytes(r["raw"])) for r in language_id.training_pieces(df).collect()]
    assert len(pieces) == len(set(pieces))
    for lang in ("aa", "bb"):
        n = sum(len(raw) - language_id.ORDER for x, raw in pieces if x == lang)
        assert 0.4 * (1 << 16) < n < 2 * (1 << 16)
    got = language_id.identify(spark, df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == len(rows) and all(r["lang_pred"] == r["lang"] for r in got)


def test_pieces_count_every_byte_once(spark, monkeypatch):
    monkeypatch.setattr(language_id, "PIECE", 7)
    texts = ["hello world, hallo welt é", "bonjour", "x", "", "0123456"]
    df = spark.createDataFrame([(i, t, "aa") for i, t in enumerate(texts * 2, 1)], "doc_id long, text string, lang string")
    learned = [r["text"].encode() for r in df.where(language_id.remainder(df["doc_id"]) != 0).distinct().collect()]
    whole = spark.createDataFrame([("aa", t) for t in sorted(set(learned))], "lang string, raw binary")
    got = language_id.gram_counts(language_id.training_pieces(df), pad=False).collect()
    assert cases.multiset(got) == cases.multiset(language_id.gram_counts(whole).collect())


def test_trees_share_nothing(monkeypatch):
    """A tree per language gives the code lengths of a common one, and memory
    grows with the languages' own strings: 100 languages of 512 KiB."""
    rng = np.random.default_rng(5)
    texts = [bytes(rng.choice(np.frombuffer(b"abcde \n\xc3\xa9", np.uint8), 400)) for _ in range(6)]

    def table(texts, of):
        parts = []
        for t, i in zip(texts, of):
            raw = np.frombuffer(b"\n\n\n" + t, np.uint8).astype(np.int64)
            code = sum(raw[j:len(raw) - 3 + j] << 8 * (3 - j) for j in range(4))
            parts.append((np.full(len(code), i), code))
        lang_of, grams = (np.concatenate(x) for x in zip(*parts))
        pairs, counts = np.unique(np.stack([lang_of, grams]), axis=1, return_counts=True)
        return pairs[0], pairs[1], counts

    known = table(texts[:4], [0, 1, 2, 1])
    raw = b"".join(texts)
    data, offsets = np.frombuffer(raw, np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    common = language_id.ContextTrees(list("xyz"), *known)
    apart = language_id.Forest(list("xyz"), *known)
    assert np.allclose(language_id.row_code_lengths(common, data, offsets), language_id.row_code_lengths(apart, data, offsets))

    def size(x):
        if isinstance(x, np.ndarray):
            return x.nbytes
        return sum(map(size, x if isinstance(x, list) else vars(x).values() if hasattr(x, "__dict__") else []))

    n = 100
    grams = [np.unique(sum(rng.integers(97, 157, 60_000) << 8 * j for j in range(4))) for _ in range(n)]
    many = language_id.Forest([f"l{i:03d}" for i in range(n)], np.repeat(np.arange(n), [len(g) for g in grams]),
                              np.concatenate(grams), np.ones(sum(map(len, grams)), np.int64))
    assert size(many.trees) < 500 << 20


def test_language_accuracy(spark):
    sf = SMALL.replace("0.001", "0.01")
    got = queries.op7_language_id(spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


# --- line CRF -------------------------------------------------------------

def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(5)
    counts = np.array([3, 1, 5, 2])
    first = np.cumsum(counts) - counts
    scores, transition = rng.normal(size=counts.sum()), rng.normal(size=(2, 2))
    before, after, total = line_crf.forward_backward(scores, first, counts, transition)
    for c in range(len(counts)):
        s = scores[first[c]:first[c] + counts[c]]
        weight = {y: math.exp(sum(s[t] * y[t] for t in range(len(s)))
                              + sum(transition[y[t - 1], y[t]] for t in range(1, len(s))))
                  for y in itertools.product((0, 1), repeat=len(s))}
        z = sum(weight.values())
        assert math.isclose(total[c], math.log(z))
        for t in range(len(s)):
            at = first[c] + t
            want = sum(w for y, w in weight.items() if y[t]) / z
            assert math.isclose(math.exp(before[at, 1] + after[at, 1] - total[c]), want)


def test_line_features_do_not_depend_on_the_batch():
    from landfall.llm.shingles import Powers

    texts = ["One line.\nTWO lines!! 12\n\n  \nOne line.", "", " \n", "*** a a a b", "été 中"]
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    together, _, rows = line_crf.line_features(np.frombuffer(b"".join(raw), np.uint8), offsets, Powers())
    alone = [line_crf.line_features(np.frombuffer(r, np.uint8), np.array([0, len(r)]), Powers())[0] for r in raw]
    assert np.allclose(together, np.concatenate(alone))
    assert rows.tolist() == [0, 0, 0, 3, 4]


def test_quality_odd_rows(spark):
    df = cases.frame(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 20)] + [(7, None, 1), (None, 1, 0), (8, 5, 0)],
                                   "doc_id long, quality int, toxic int")
    got = line_crf.quality(spark, df, labels).collect()
    assert len(got) == df.count()
    for r in got:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] in (1, 2, 3, 100):
            assert r["score"] == line_crf.EMPTY_SCORE
    none = line_crf.quality(spark, df, labels.limit(0)).collect()
    assert {round(r["score"], 9) for r in none} == {0.5, line_crf.EMPTY_SCORE}
    assert line_crf.quality(spark, df.limit(0), labels).collect() == []


def test_quality_sample_is_drawn_from_known_texts(spark, monkeypatch):
    """Labels without a text, or with one that is too long, do not use up the
    sample; lines are bounded too."""
    monkeypatch.setattr(line_crf, "MAX_DOCS", 40)
    docs = spark.createDataFrame([(i, ("fine words here. " * 5 if i % 2 else "### $$$ 123 *** ") + "\n" * (i % 3)) for i in range(200)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100_000, 120_000)] + [(i, i % 2) for i in range(200)], "doc_id long, quality int")
    got = {r["doc_id"]: r["predicted"] for r in line_crf.quality(spark, docs, labels).collect()}
    assert np.mean([got[i] == i % 2 for i in got]) == 1.0
    monkeypatch.setattr(line_crf, "MAX_LINES", 30)
    seen = []
    monkeypatch.setattr(line_crf.LineField, "fit", lambda self, x, rows, labels: seen.append(len(x)))
    with Scratch(spark, "t") as scratch:
        line_crf.fit(scratch, docs, labels)
    assert 0 < seen[0] < 60


def test_quality_accuracy(spark):
    sf = SMALL.replace("0.001", "0.01")
    got = queries.op1_line_crf(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["quality"] == r["predicted"] for r in got]) > 0.95


def test_random_texts_do_not_crash():
    from landfall.llm.shingles import Powers

    rng = random.Random(8)
    field = line_crf.LineField()
    for _ in range(50):
        raw = [bytes(rng.choice(b"a \n*\xc3\xa9") for _ in range(rng.randint(0, 30))) for _ in range(5)]
        offsets = np.append(0, np.cumsum([len(r) for r in raw]))
        score = line_crf.document_scores(field, np.frombuffer(b"".join(raw), np.uint8), offsets, Powers())
        assert ((score >= 0) & (score <= 1)).all()
