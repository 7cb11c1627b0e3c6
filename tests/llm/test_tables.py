"""WARC, HTML, top-k, similarity join, packing and the pipeline against brute force and edge cases."""

import base64
import collections
import gzip
import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import html_text, language, ngram_join, packing, quality_rules, topk, warc
from martloom.llm.components import components
from martloom.llm.queries import REGISTRY
from martloom.llm.shingles import shingle_set, word_hashes
from martloom.workspace import fresh_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- WARC ---


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip_with_revisits(spark):
    rows = [
        (1, "http://a/1", "<p>same"), (5, "http://a/5", "<p>same"), (3, None, "<p>same"), (4, "http://a/4\r\nX: y", None), (2, "u", ""),
        (7, "v", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx" + "long " * 40_000), (8, "w", "one"), (9, "w", "two"),
        (6, "r", "twice"), (6, "r", "twice"), (None, "n", "null page"), (10, "q", "null page"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"digest": F.lit("x"), "winner": F.lit(1), "capture": F.lit(2), "payload_bytes": F.lit(3)}
    )
    path = fresh_dir(spark, "warc-test")
    warc.write(warc.captures(pages), path)
    records = warc.read_records(spark, path)
    assert {r.record_type: r["count"] for r in records.groupBy("record_type").count().collect()} == {
        "request": 12, "metadata": 12, "response": 7, "revisit": 5,
    }
    found = warc.assemble(records).collect()
    assert len(found) == len(rows)
    last = {}
    for page, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
    htmls = collections.defaultdict(list)
    for page, _, html in rows:
        htmls[page].append(html or "")
    twice = []
    for r in found:
        assert r.request.concurrent_to == r.main.record_id == r.metadata.concurrent_to == r.capture
        page = r.metadata.fields["pageId"]
        page = int(page) if page else None
        html = htmls[page][0]
        assert r.main.digest == digest(html) and int(r.metadata.fields["payloadBytes"]) == len(html.encode())
        if page == 6:
            twice.append(r.main.record_type)
        elif page == last[html]:
            assert r.main.record_type == "response" and bytes(r.main.payload).decode() == html
            assert r.main.payload_digest == r.main.digest and r.main.payload_bytes == len(html.encode())
        else:
            assert r.main.record_type == "revisit" and f":{last[html]}:" in r.main.refers_to
    assert sorted(twice) == ["response", "revisit"]
    assert all(r.main.uri == "http://a/4X: y" for r in found if r.metadata.fields["pageId"] == "4")


def test_warc_files_are_archives(spark):
    path = fresh_dir(spark, "warc-test")
    warc.write(warc.captures(spark.read.parquet(f"{SF}/pages.parquet").limit(20)), path)
    for r in spark.read.format("binaryFile").load(path).collect():
        data = gzip.decompress(bytes(r.content))
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        assert [h["warc-type"] for h, _ in warc.parse(bytes(r.content))] == [h["warc-type"] for h, _ in warc.parse(data)]
        # A member per half of the file reads the same.
        cut = data.index(b"WARC/1.1\r\n", 10)
        assert len(list(warc.parse(gzip.compress(data[:cut]) + gzip.compress(data[cut:])))) == len(list(warc.parse(data)))


def test_warc_min_revisit_and_empty(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "yyyy"), (4, "a", "yyyy"), (2, "a", "x")], "page_id long, url string, html string")
    assert warc.captures(pages, min_revisit_bytes=2).select("capture").distinct().count() == 5
    rows = {r.page_id: r.refers_to for r in warc.captures(pages, min_revisit_bytes=2).collect()}
    assert rows[1] is None and rows[2] is None and rows[4] is None and ":4:" in rows[3]
    path = fresh_dir(spark, "warc-test")
    warc.write(warc.captures(pages.limit(0)), path)
    assert warc.assemble(warc.read_records(spark, path)).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 50\r\n\r\nshort"))


# --- HTML ---


def article(html):
    body = re.search(r"<article>(.*)</article>", html, re.S).group(1)
    from html import unescape

    parts = re.split(r"</?(?:p|h1)>", body)
    return "\n".join(x for x in (" ".join(unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts) if x)


def test_html_equals_the_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    found = REGISTRY["op10_main_text"][0](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b<br>c  d&nbsp;e", "a\nb c d e"),
        ("<nav><p>menu</p></nav><p>Real text here.</p><footer>foot</footer>", "Real text here."),
        ("<div class='site-header'>top</div><p>body text</p><div id=comments><p>reader says</p></div>", "body text"),
        ("<article><h1>T</h1><p>x</p><aside>side</aside><p>y</p></article><p>outside " + "z " * 90 + "</p>", "T\nx\ny"),
        ("<p>text</p><script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>more</p>", "text\nmore"),
        ("<form><p>name</p></form><p>kept</p><div role=navigation>no</div><div hidden>no</div>", "kept"),
        ("<main><p>one</p><ul><li>two</li><li>three</li></ul></main>", "one\ntwo\nthree"),
        ("<p>open &lt;b&gt; &#x41; &#66; &copy </p", "open <b> A B ©"),
        ("<div class='ad'>buy</div><article><p>a</article>", "a"), ("<p>" + "w " * 100_000 + "</p>", ("w " * 100_000).strip()),
    ],
)
def test_html_cases(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    "attributes, hidden",
    [
        ("style='overflow:hidden'", False), ('data-title="The hidden valley"', False), ("href=/hidden-gems", False), ("href='/a?id=nav'", False),
        ("data-hidden='false'", False), ("data-id=nav", False), ("title='a class=ad b'", False), ("data-x=\"role='menu'\"", False),
        ("aria-hidden=false", False), ("class = 'story' id=x class=ad", False), ("hidden-x", False), ("x=1 y= 'id=nav'", False),
        ("hidden", True), ("HIDDEN=''", True), ("title='x'hidden", True), ("style='a:b' / id=nav", True), ("data-x='1' CLASS = \"big ad\"", True),
        ("role=menu", True), ("a= b=c aria-hidden='true'", True), ("href=/x/y id='side-bar'", True),
    ],
)
def test_html_compares_whole_attribute_names(attributes, hidden):
    assert html_text.is_boilerplate(" " + attributes) == hidden
    assert html_text.main_text(f"<article {attributes}><p>Some text</p></article>") == ("" if hidden else "Some text")
    assert html_text.main_text(f"<p>one <span {attributes}>two</span> three</p>").replace("\n", " ") == ("one three" if hidden else "one two three")


LONG = "A sentence of the story that is told here at some length, with more to follow. " * 4
LINKS = "".join(f"<p><a href='/r{i}'>reference {i}</a></p>" for i in range(3))


@pytest.mark.parametrize(
    "html, lines",
    [
        # Link-only blocks in mid-article part two stretches; both are kept, the smaller one too.
        (f"<div><p>{LONG}</p><p>{LONG}</p>{LINKS}<p>{LONG}</p><p>The end.</p></div>", [LONG, LONG, LONG, "The end."]),
        # Unlisted boilerplate around the text, and a short last paragraph within it.
        (f"<div>We use files.</div><div><h1>Head</h1><p>{LONG}</p><p>So.</p></div><div>All rights reserved.</div>", ["Head", LONG, "So."]),
        # As many lines of no weight as the boilerplate has blocks.
        (f"<p>{LONG}</p><nav><p>a</p><p>b</p><p>c</p></nav><div>Notice of some kind</div>", [LONG]),
        (f"<div><p>{LONG}</p><ul><li>one</li><li>two</li></ul></div>", [LONG, "one", "two"]),
        (f"<div><p>One.</p><p>Two.</p><p>Three.</p><p>{LONG}</p></div>", ["One.", "Two.", "Three.", LONG]),
    ],
)
def test_html_without_content_elements(html, lines):
    assert html_text.main_text(html) == "\n".join(x.strip() for x in lines)


def test_html_finds_articles_without_their_elements(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    exact = 0
    for r in pages:
        bare = re.sub(r"<(/?)article>", r"<\1div>", r.html)
        assert html_text.main_text(bare) == article(r.html)
        plain = re.sub(r"<(/?)(?:nav|footer)>", r"<\1div>", bare.replace('<div class="ad">', "<div>"))
        exact += html_text.main_text(plain) == article(r.html)
    assert exact > 0.95 * len(pages)


@pytest.mark.parametrize(
    "name", "no-sidebar has-comments article-header content-menu share-price social-policy skip-none sidebar widget related".split()
)
def test_html_wrappers_of_the_article_stay(name):
    story = f'<article><h1>Head</h1><p>{LONG}</p></article>'
    assert html_text.main_text(f'<div class="{name}">{story}</div><footer>foot</footer>') == f"Head\n{LONG.strip()}"


def test_html_names_within_articles():
    html = '<article><div class="article-header"><h1>Title</h1></div><p class="related-work">Para.</p><div class="share-buttons">x</div></article>'
    assert html_text.main_text(html) == "Title\nPara."
    # A page within a form, as some frameworks write it; comments are no main text, however long.
    assert html_text.main_text(f"<form><p>{LONG}</p><p>{LONG}</p></form><p>So.</p>") == f"{LONG.strip()}\n{LONG.strip()}"
    assert html_text.main_text(f"<p>Short.</p><div class=comments><article><p>{LONG * 9}</p></article></div>") == "Short."


def test_html_windows_weigh_text_outside_content():
    outside = "<div><p>" + LONG * 12 + "</p></div>"
    assert html_text.main_text(f"<article><p>{LONG}</p></article><div>Short notice</div>") == LONG.strip()
    assert html_text.main_text(f"<article><p>{LONG}</p></article><nav>x</nav><nav>x</nav>{outside}") == f"{LONG.strip()}\n{(LONG * 12).strip()}"


@pytest.mark.parametrize(
    "html, length",
    [
        ('<a "' * 250_000, 999_996), ('<b x=">' * 150_000, 0), ("<span></p>" * 100_000 + "end", 3), ("<p><caption>" + "<span>" * 90_000 + "<div></div>" * 90_000, 0),
        ("<a" + " " * 1_000_000 + "></a>x", 1), ("&#" + "9" * 1_000_000 + ";", 1), ("<div class=sidebar>" * 60_000 + "x", 0),
        ('<p title="unclosed>one</p><p>two</p>', 7), ("<!-" * 300_000, 0), ("<a href='" + "<i>" * 200_000, 0),
    ],
)
def test_html_broken_markup_takes_linear_time(html, length):
    begun = time.perf_counter()
    assert len(html_text.main_text(html)) == length
    assert time.perf_counter() - begun < 30


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", "<p>x</p>")], "page_id long, url string, html string")
    found = html_text.extract(pages.withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(5))).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found) == [(0, "x", 1), (1, "", 0), (1, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


# --- top-k ---


def brute_top(rows, k, scale=256):
    ok = [(i, np.floor(np.array(v, float) * scale).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, v in ok:
        if q % 50 == 0:
            best = sorted((-int(v @ w), c) for c, w in ok if c != q and len(w) == len(v))[:k]
            out[q] = [(c, -s) for s, c in best]
    return out


def test_topk_prunes_exactly():
    rng = np.random.default_rng(4)
    for dims, spread in ((40, 1.0), (9, 0.2), (64, 3.0)):
        q, c = np.floor(rng.normal(0, spread, (dims, 70)) * 64), np.floor(rng.normal(0, spread, (dims, 900)) * 64)
        c[:, 300:340] = c[:, 0:1]  # ties
        found = topk.search_tile(q, np.arange(70), c, np.arange(900), 5)
        scores = (q.T @ c).astype(np.int64)
        for i in range(70):
            best = sorted((-scores[i, j], j) for j in range(900) if j != i)[:5]
            assert [(b, s) for a, b, s in found if a == i] == [(j, -s) for s, j in best]


def test_topk_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 12)]) for i in range(0, 160)]
    rows += [(400, rows[7][1]), (401, rows[7][1]), (450, None), (500, [1.0, None] + [0.0] * 10), (550, [float("nan")] * 12), (None, rows[1][1]),
             (600, []), (650, [1.0, 2.0]), (651, [0.5, 1.0]), (700, [float("inf")] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "q": F.lit(0), "rank": F.lit(9), "score": F.lit(2)})
    found = collections.defaultdict(list)
    for r in topk.top_k(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    assert dict(found) == {q: b for q, b in brute_top(rows, 5).items() if b}
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    huge = spark.createDataFrame([(0, [1e12, 2.0]), (1, [3e12, 1.0]), (2, [-1e12, 0.5])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in topk.top_k(huge, F.col("id") == 0).orderBy("rank").collect()] == [1, 2]


# --- similarity join ---


def brute_sets(rows, k):
    out = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(words[a : a + k]) for a in range(max(1, len(words) - k + 1))} if words else set()
    return out


def brute_components(sets, percent):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in sets}


def copies(seed, n_groups, variants, alphabet=4000):
    rng = random.Random(seed)
    rows = []
    passage = [f"p{j}" for j in range(50)]
    for _ in range(n_groups):
        base = [f"w{rng.randrange(alphabet)}" for _ in range(rng.choice((1, 2, 3, 8, 20, 60, 150, 300)))]
        if rng.random() < 0.3:
            base[1:1] = passage
        for _ in range(rng.choice(variants)):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4, 9))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_join_equals_brute_force(spark, monkeypatch, k, percent):
    rows = copies(percent, 40, (1, 2, 3, 12))
    sets = brute_sets(rows, k)
    monkeypatch.setattr(ngram_join, "GROUP_CHARS", 20_000)
    found = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in found} == {i: (len(sets[i]), c) for i, c in brute_components(sets, percent).items()}


def test_join_in_blocks_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{j}" for j in range(120)]
    rows = []
    for i in range(220):
        words = list(base)
        for _ in range(rng.randrange(0, 14)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99999)}"
        rows.append((i, " ".join(words[: rng.randrange(100, 121)])))
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 16)
    sets = brute_sets(rows, 3)
    found = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r.id: r.component_id for r in found} == brute_components(sets, 90)


def test_signatures_meet_by_pigeonhole():
    """Any two sets as far apart as allowed share a key, whatever counts as frequent."""
    rng = np.random.default_rng(6)
    for percent in (90, 80, 60):
        for n in (1, 2, 5, 9, 10, 30, 144, 700):
            for _ in range(30):
                whole = rng.integers(0, 2**63, 3 * n + 9).astype(np.uint64)
                both = whole[:n]
                spare = n * 100 // percent - n
                a = rng.integers(0, spare + 1)
                left, right = np.unique(np.r_[both, whole[n : n + a]]), np.unique(np.r_[both, whole[2 * n : 2 * n + spare - a]])
                inter, union = len(np.intersect1d(left, right)), len(np.union1d(left, right))
                if 100 * inter < percent * union:
                    continue
                frequent = rng.choice(whole, int(len(whole) * rng.choice((0, 0.3, 0.5, 0.7, 1))), replace=False)
                key = lambda s: ngram_join.signatures(s, s[~np.isin(s, frequent)], percent)
                assert len(np.intersect1d(key(left), key(right)))


def test_hamming_distance_is_a_lower_bound():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 400, 200).astype(np.uint64)) for _ in range(20)]
    sketch = ngram_join.sketches(sets, 4)
    for i in range(20):
        for j in range(i):
            assert np.bitwise_count(sketch[i] ^ sketch[j]).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_join_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "word " * 30_000), (8, "word " * 29_999), (None, "a b"),
            (9, "Éa b"), (10, "éa b"), (6, "a b c"), (11, "x" * 3_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "kind", "component_id", "unit", "_gone")})
    found = collections.defaultdict(list)
    for r in ngram_join.link(df, 3, 90).collect():
        found[r.id].append((r.n_shingles, r.component_id))
    assert found[1] == [(0, 1)] and found[2] == [(0, 2)] and found[3] == [(0, 3)]
    assert found[4] == found[5] == [(1, 4)] and found[6] == [(1, 6)] * 2
    assert found[7] == found[8] == [(1, 7)] and found[9] == [(1, 9)] and found[10] == [(1, 10)] and found[11] == [(1, 11)]
    assert found[None] == [(1, None)]
    assert ngram_join.link(df.limit(0), 3, 90).count() == 0
    kept = ngram_join.keep_one(df.select("*", F.lit("en").alias("lang")), 3, 90)
    assert kept.columns == [*df.columns, "lang"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 9, 10, 11]


def test_words_hash_alike_across_pieces(monkeypatch):
    text = b"one two\tthree four " * 50
    whole = word_hashes(text)
    monkeypatch.setattr("martloom.llm.shingles.SLICE", 11)
    assert (word_hashes(text) == whole).all() and len(whole) == 200
    assert len(word_hashes(b"x" * 100 + b" y")) == 2
    assert len(shingle_set("a a a a a", 3)) == 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), 100)[0].collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), 0)[0].count() == 0


# --- packing ---


def brute_pack(pieces, capacity, per_source):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for i in sorted(range(len(pieces)), key=lambda i: (-pieces[i][0], i)):
        size, source, cluster = pieces[i]
        fits = [
            (capacity - sum(x[0] for x in b) - size, j)
            for j, b in enumerate(bins)
            if sum(x[0] for x in b) + size <= capacity and all(x[2] != cluster for x in b) and sum(x[1] == source for x in b) < per_source
        ]
        j = min(fits)[1] if fits else len(bins)
        if j == len(bins):
            bins.append([])
        bins[j].append(pieces[i])
        out.append((i, j))
    return [j for _, j in sorted(out)]


def test_pack_shard_equals_brute_force():
    rng = random.Random(4)
    for _ in range(30):
        pieces = [(rng.randrange(0, 100), rng.choice("aab"), rng.choice([1, 1, 1, rng.randrange(50)])) for _ in range(120)]
        assert packing.pack_shard(*map(list, zip(*pieces)), 100, 2) == brute_pack(pieces, 100, 2)


def test_packing_keeps_every_word_and_all_conflicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    more = [(None, None, None, None, None), (5000, "", None, None, None), (5001, "w " * 9000, None, "src0", 1), (5002, "Twin copy", None, "s", 1),
            (5003, "twin  copy", None, "s", 1), (5003, "twin  copy", None, "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, DOCS)).withColumns({c: F.lit(1) for c in ("shard", "bin", "piece", "size", "_id", "cluster")})
    found = packing.pack(docs, capacity=500, per_source=2).collect()
    words = collections.Counter()
    for r in docs.collect():
        words[r.doc_id] += len((r.text or "").split())
    got, bins = collections.Counter(), collections.defaultdict(list)
    for r in found:
        got[r.doc_id] += r.size
        bins[r.bin_id].append(r)
    assert got == words and set(got) == set(words)
    for rows in bins.values():
        assert sum(r.size for r in rows) <= 500 and max(collections.Counter(r.source for r in rows).values()) <= 2
        assert len({r.cluster for r in rows}) == len(rows)
    twins = [r.bin_id for r in found if r.doc_id in (5002, 5003)]
    assert len(set(twins)) == 3
    assert packing.pack(docs.limit(0)).count() == 0
    assert max(r.start + r.size for r in found if r.doc_id == 5001) == 9000


def test_packing_query_keeps_near_copies_apart(spark, tmp_path):
    base = [f"w{i}" for i in range(60)]
    texts = [(1, " ".join(base)), (2, " ".join([*base, "one"])), (3, " ".join([*base, "two", "three"])), (4, "Élan É x"), (5, "élan  é X"), (6, ""),
             (7, None), (8, "other words"), (None, "OTHER words"), (9, "alone here"), (9, "full " * packing.CAPACITY), (9, "wide " * packing.CAPACITY)]
    rows = [(i, t, None, f"s{n}", None) for n, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = REGISTRY["op2_packing"][0](spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    by = collections.defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    for group in ((1, 2, 3), (4, 5), (6, 7), (8, None)):
        assert len({r.bin_id for i in group for r in by[i]}) == len(group) and len({r.cluster for i in group for r in by[i]}) == 1
    assert len({r.bin_id for r in by[9]}) == 3 and len({by[i][0].cluster for i in (1, 4, 6, 8, 9)}) == 5


def test_packing_query_equals_brute_force(spark):
    """At this size there is one shard: the query's bins are those of the plain search."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {(r.doc_id, r.piece): r for r in REGISTRY["op2_packing"][0](spark, SF).collect()}
    rest = sorted((r for r in found.values() if r.bin_id.startswith("bin")), key=lambda r: (str(r.doc_id), r.piece))
    bins = brute_pack([(r.size, r.source, r.cluster) for r in rest], packing.CAPACITY, packing.PER_SOURCE)
    assert [int(r.bin_id.split("-")[-1]) for r in rest] == bins
    for d in docs:
        n = len(d.text.split())
        assert sum(r.size for (i, _), r in found.items() if i == d.doc_id) == n


# --- pipeline ---


def test_pipeline_stages_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    known = steps["language"](spark, docs, sf)
    assert known.columns == docs.columns
    model = language.fit(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    fine = {r.doc_id for r in language.label(docs, model).collect() if r.lang_pred != "und" and r.score >= language.LEAST}
    assert {r.doc_id for r in known.collect()} == fine
    good = steps["quality"](spark, known, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality_rules.report(known, labels).collect() if r.kept}
    single = steps["near_copies"](spark, good, sf)
    sets = brute_sets([(r.doc_id, r.text) for r in good.collect()], 5)
    assert single.columns == docs.columns
    assert {r.doc_id for r in single.collect()} == {i for i, c in brute_components(sets, 80).items() if i == c}
    packed = steps["packing"](spark, single, sf)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in single.collect()}


def test_pipeline_runs_over_edge_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", None, None), (3, "the cat sat on the mat and " + " ".join(f"w{i}" for i in range(40)), "en", None, 3)]
    rows += [rows[2], (4, rows[2][1] + " x", "en", "s", 1), (5, "123 456", "en", "s", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.size) for r in found] == [(3, 47)]
