"""The language-model operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.llm import html, lines, mixing, ngram, ogg, packing, quality, queries, substring, topk, urls
from corvane.llm._arrow import Words
from corvane.llm._spark import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, texts, ids=None, **more):
    rows = [(i, t) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def corpus(n=80, seed=4):
    """Texts with whole copies, near copies, shared passages, short ones, nulls and one long document."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage = text(70)
    out = [None, "", " \n ", "one", "one two three", "one two three", text(9000)]
    while len(out) < n:
        kind = r.randrange(6)
        if kind == 0:
            out.append(r.choice(out))
        elif kind == 1 and out[-1]:
            w = out[-1].split(" ")
            for _ in range(1 + len(w) // 60):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            out.append(" ".join(w))
        elif kind == 2:
            out.append(f"{text(r.randrange(1, 40))} {passage} {text(r.randrange(1, 40))}")
        elif kind == 3:
            out.append("same same " * r.randrange(1, 80))
        else:
            out.append(text(r.randrange(1, 200)))
    return out


@given(st.lists(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85 ab cé語", max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words(texts):
    w = Words(pa.array(texts, pa.string()))
    at = 0
    seen = {}
    for t, a, b in zip(texts, w.first[:-1], w.first[1:], strict=True):
        own = [w.raw[s:e].tobytes().decode() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)]
        assert own == words(t)
        for x, h in zip(own, w.hash[a:b], strict=True):
            assert seen.setdefault(x, h) == h
        at = b
    assert at == len(w) and len(set(seen.values())) == len(seen)


def test_components(spark):
    r = random.Random(9)
    pairs = [(r.randrange(90), r.randrange(90)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(30)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()
    assert {x.node: x.root for x in got} == {x: find(x) for x in parent} and len(got) == len(parent)
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# --- 1: n-gram join ---------------------------------------------------------


def brute_join(ids, texts, k=5, least=0.8):
    sets = [frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if (w := words(t)) else frozenset() for t in texts]
    links, parent = Counter(), list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    low = defaultdict(list)
    for i in range(len(texts)):
        low[find(i)].append(ids[i])
    return sorted((ids[i], min(low[find(i)]), links[i]) for i in range(len(texts)))


@pytest.mark.parametrize("block", [4, 512])
def test_ngram_join(spark, block):
    texts = corpus(90)
    got = ngram.join(frame(spark, texts), block=block).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute_join(range(len(texts)), texts)


def test_ngram_join_cases(spark):
    assert ngram.join(frame(spark, [])).count() == 0
    d = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None)], "doc_id bigint, text string").withColumns({"node": F.lit(1), "n": F.lit("x"), "key": F.lit(2)})
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram.join(d).collect()), key=str)
    assert got == sorted([(7, 3, 3), (7, 3, 3), (3, 3, 3), (None, 3, 3), (None, None, 0)], key=str)
    kept = ngram.keep_one(d)
    assert kept.columns == d.columns and 3 in [r.doc_id for r in kept.collect()] and 7 not in [r.doc_id for r in kept.collect()]


def test_ngram_depth_follows_the_data():
    """Pairs far above the threshold leave prefixes whole, pairs close to it shorten them."""
    assert ngram.depth({}, 0.8, 16, 0.9999)[0] == 3 and ngram.depth({}, 0.5, 4, 0.9)[0] == 1
    assert ngram.depth({1.0: 10, 0.95: 90}, 0.8, 16, 0.9999)[0] == 4
    assert ngram.depth({0.95: 50, 0.8: 50}, 0.8, 16, 0.9999)[0] == 3
    assert ngram.depth({0.81: 50}, 0.8, 16, 0.999999)[0] == 2


def test_ngram_recall_in_one_template(spark):
    """Documents of one template are near misses of each other; pairs close to the threshold among them are found."""
    r = random.Random(11)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for k in range(150):
        own = [f"o{k}-{i}" for i in range(14)]
        for copy in (own, [*own[:-1], f"z{k}"] if k % 2 else [*own[:-1], *own[-1:], "end"]):
            w = list(shared)
            for at, x in zip(range(4, 60, 4), copy, strict=False):
                w.insert(at * 2 % 60, x)
            texts.append(" ".join([*w, *copy]))
    want = brute_join(range(len(texts)), texts)
    got = sorted((x.doc_id, x.class_id, x.n_links) for x in ngram.join(frame(spark, texts), block=64).collect())
    links, found = sum(n for *_, n in want), sum(n for *_, n in got)
    print(f"found {found} of {links} links")
    assert links >= 200 and found >= 0.99 * links


# --- 2: packing -------------------------------------------------------------


def test_merging_by_rank_is_merging_by_the_list():
    """Over the vocabulary's whole merge table."""
    assert packing.same_merges(queries.vocabulary()) == []


def test_tokens_equal_the_tokenizer():
    """Both ways of encoding: every character between others, every kind of space, added tokens."""
    from tokenizers import Tokenizer

    path = queries.vocabulary()
    full = Tokenizer.from_file(path)
    encode = packing.encoder(path)
    r = random.Random(1)
    special = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u3000", "\u200b", "'s", "'LL", "1", "a", "é", "語", "क्", "!", "\U0001f600", "<|endoftext|>"]
    texts = ["", "<|endoftext|> x", "end <|endoftext|> next", "don't I'll", "e\u0301 \u0301", *("".join(r.choice(special) for _ in range(r.randrange(1, 30))) for _ in range(3000))]
    texts += ["".join(map(chr, range(packing.LATIN + 1))), *("".join(chr(r.randrange(packing.LATIN + 1)) for _ in range(300)) for _ in range(500))]
    texts += [f"a{c} {c}b  {c}\n{c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000, 7), *range(0x10000, 0x110000, 997)])]
    for t, want in zip(texts, full.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(t) == want.ids, ascii(t)
    assert encode("<|endoftext|>") == [50256]


@given(st.integers(1, 100_000), st.integers(0, 12))
@settings(max_examples=100, deadline=None)
def test_pieces(n, k):
    own = packing.pieces(n, 1 << k)
    assert sum(s for _, s in own) == n and all(s & (s - 1) == 0 and s <= 1 << k for _, s in own)
    assert [a for a, _ in own] == list(np.cumsum([0, *(s for _, s in own)])[:-1])


def test_packing(spark):
    texts = corpus(30)
    d = frame(spark, texts).withColumn("row", F.lit("clash")).withColumn("ids", F.lit(0))
    encode = packing.encoder(queries.vocabulary())
    got = defaultdict(list)
    rows = packing.pack(d, queries.vocabulary()).collect()
    for r in rows:
        got[r.doc_id].append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, t in enumerate(texts):
        want = [*encode(t or ""), 0]
        own = sorted(got[i], key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == want
        for r in own:
            assert r.length == len(r.ids) <= 1024 and r.doc_tokens == len(want) and r.offset == 0
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
    assert packing.pack(frame(spark, []), queries.vocabulary()).count() == 0
    none = packing.pack(spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id bigint, text string"), queries.vocabulary()).collect()
    assert {r.doc_id for r in none} == {None} and sum(r.length for r in none) == 2 * none[0].doc_tokens
    with pytest.raises(ValueError, match="power"):
        packing.pack(d, queries.vocabulary(), longest=1000)


# --- 3: url filter ----------------------------------------------------------


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url[url.index("://") + 3 :]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = re.match(r"[^?#]*", rest[cut:])[0]
    fit = [(len(h), len(p), h + p, v) for h, p, v in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


URLS = [None, "", "no scheme", "http://", "http://ORG/x", "HTTP://A.Example.ORG/es/1", "http://example.org/en/12", "http://example.org/en/2", "http://xexample.org/es/", "http://a.com/fr/?q", "http://a.com/de/#x", "http://com", "http://com?x/fr/", "http://com/de/", "http://u@h.com:80/fr/", "x://y://z.org/a", "http://é.org/ü", "http://a..org/", "http://.org/", "http://org./"]


def test_url_filter(spark):
    many = URLS + [f"http://h{i % 7}.example.org/{'es' if i % 2 else 'en'}/{i}" for i in range(300)]
    d = spark.createDataFrame(list(enumerate(many)), "page_id bigint, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    for per in (10, 200_000):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(d, rules, rows_per_range=per).collect()}
        assert got == {i: brute_url(u) for i, u in enumerate(many)}
    assert urls.judge(d.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(d, rules.limit(0), default="block").collect()} == {"block"}


def test_url_rules_over_ranges(spark):
    """More rules than pages, nested hosts, ties; every rule against every page by brute force."""
    r = random.Random(2)
    hosts = ["a", "b.a", "c.b.a", "d", "a.d", "ba", "a.ba"]
    rules = list({(r.choice(hosts), "/" + r.choice(["", "x", "x/y", "z"])): r.choice(["allow", "block"]) for _ in range(40)}.items())
    pages = [(i, f"p://{r.choice(['', 'q.'])}{r.choice(hosts)}/{r.choice(['', 'x', 'x/y/z', 'w'])}") for i in range(200)]
    got = urls.judge(spark.createDataFrame(pages, "page_id int, url string"), spark.createDataFrame([(h, p, v) for (h, p), v in rules], "host string, path string, verdict string"), rows_per_range=5)
    for row in got.collect():
        fit = [(len(h), len(p), h + p, v) for (h, p), v in rules if (row.host == h or row.host.endswith("." + h)) and row.path.startswith(p)]
        assert (row.rule, row.verdict) == (max(fit)[2:] if fit else (None, "allow"))


# --- 4: mixing --------------------------------------------------------------


def test_targets():
    assert mixing.targets([10, 10], [5, 2], 20, 3) == pytest.approx([100 / 7, 40 / 7])
    got = mixing.targets([1, 100, 100], [5, 2, 1], 201, 3)
    assert got[0] == 3 and sum(got) == pytest.approx(201) and got[1] / got[2] == pytest.approx(2)
    assert mixing.targets([], [], 0, 3) == [] and mixing.targets([0, 5], [1, 1], 5, 3) == pytest.approx([0, 5])


@given(st.integers(1, 5000), st.integers(0, 10**9))
@settings(max_examples=40, deadline=None)
def test_permutation(n, key):
    there = mixing.permute(np.arange(n), n, key)
    assert sorted(there.tolist()) == list(range(n)) and mixing.permute(there, n, key, True).tolist() == list(range(n))


@given(st.integers(1, 3000), st.integers(1, 200), st.integers(1, 64))
@settings(max_examples=60, deadline=None)
def test_stream_takes_its_target(size, share, block):
    """Every word comes as often as any other, or once more, and the target is met to the word."""
    own = mixing.Stream(3, size, min(3 * size, size * share // 66), block, 17)
    epoch, index, take = own.take(np.arange(own.slots))
    assert take.sum() == own.target and (take > 0).all()
    count = np.zeros(own.blocks, int)
    np.add.at(count, index, take)
    full = np.minimum(block, size - np.arange(own.blocks) * block)
    assert (count >= full * own.whole).all() and (count <= full * (own.whole + 1)).all() and len(set(zip(epoch, index, strict=True))) == own.slots


def test_throw():
    got = mixing.throw(100_000, 7, (1, 2))
    assert got.sum() == 100_000 and abs(got - 100_000 / 7).max() < 600 and (got == mixing.throw(100_000, 7, (1, 2))).all() and (got != mixing.throw(100_000, 7, (1, 3))).any()


def test_mixing(spark):
    r = random.Random(6)
    texts = [" ".join(["w"] * r.randrange(0, 900)) for _ in range(120)] + [None, "", "x " * 20_000]
    source = [r.choice(["b", "a", None, "é"]) for _ in texts]
    source[0] = "tiny"
    texts[0] = "just a few"
    d = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(zip(texts, source, strict=True))], "doc_id int, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(d, block=16, keep=("doc_id",)).collect()
    assert sorted(x.doc_id for x in got) == list(range(len(texts)))
    by = defaultdict(list)
    for x in got:
        assert x["size"] == len(words(texts[x.doc_id])) and x.taken <= 3 * x["size"]
        by[x.source].append(x)
    for rows in by.values():
        assert sum(x["size"] for x in rows) == rows[0].source_size
        assert abs(sum(x.taken for x in rows) - rows[0].target) <= 0.5
    again = mixing.mix(d, block=16, keep=("doc_id",)).collect()
    assert sorted((x.doc_id, x.taken) for x in got) == sorted((x.doc_id, x.taken) for x in again)
    whole = mixing.mixed(d.withColumn("n_chars", F.lit(0)), block=16)
    assert whole.columns == [*d.columns, "n_chars"]
    count = Counter()
    for x in whole.collect():
        count[x.doc_id] += len(words(x.text))
        assert x.n_chars == len(x.text)
    assert count == Counter({x.doc_id: x.taken for x in got if x.taken})


def test_mixing_small_sources(spark):
    """Sources far under a block still come to their targets."""
    rows = [(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate([(300, "a"), (310, "b"), (290, "c"), (7, "d"), (7, "d")])]
    d = spark.createDataFrame([*rows, (None, None, "d"), rows[3]], "doc_id int, text string, source string")
    got = mixing.mix(d).collect()
    assert len(got) == 7
    for s in "abcd":
        own = [x for x in got if x.source == s]
        assert abs(sum(x.taken for x in own) - own[0].target) <= 0.5, s
        assert all(x.taken <= 3 * x["size"] for x in own)


def test_mixing_over_many_shards(spark):
    d = spark.createDataFrame([(i, "x " * 5000, "ab"[i % 2]) for i in range(4)], "doc_id int, text string, source string")
    m = mixing.Mix(d, block=4, per_shard=2)
    at = m.slots.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("top")).collect()
    assert len(at) > 1024 and all(x.n == x.d == x.top + 1 for x in at)
    assert m.taken().agg(F.sum("n")).first()[0] == pytest.approx(20_000, abs=1)


def test_mixing_empty(spark):
    d = spark.createDataFrame([], DOCS)
    assert mixing.mix(d).count() == 0 and mixing.mixed(d).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, None, None, None, None)], DOCS)).first()["taken"] == 0


# --- 5: html ----------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><p>First <b>bold</b>\n\n text&nbsp;here.</p><script>var x = "</p>";</script><p>Second &lt;tag&gt; 5 &gt; 3.</p><div class="ad">Buy</div><!-- no --></article>
<section class="comments"><div class="comment"><p>nice post</p></div></section><aside class="sidebar"><p>Related</p></aside><footer>&copy; 2020</footer></body></html>"""


def test_html_blocks():
    got = [t for _, t, _ in html.blocks(PAGE)]
    assert "First bold text here." in got and "Second <tag> 5 > 3." in got and not any("var x" in t or "p{}" in t for t in got)
    assert html.blocks("") == [] and html.blocks("<p>a<div") and html.blocks("x < y")[0][1] == "x < y"
    assert [t for _, t, _ in html.blocks("<p>cut &am")] == ["cut &am"]


def test_html_loses_nothing():
    """Elements left open, and labels far back in a long class, are seen."""
    for tag in ("video src=x", "svg", "select", "object", "noscript", "canvas", "title", "iframe"):
        assert [t for _, t, _ in html.blocks(f"<p>one</p><{tag}><p>two</p>")] == ["one", "two"]
    assert [t for _, t, _ in html.blocks("<p>one</p><script>var x<p>two</p>")] == ["one"]
    assert {".comments", ".sidebar"} <= set(html.blocks('<div class=" a b c d e f comments sidebar">x</div>')[0][0])
    assert [t for _, t, _ in html.blocks("<p>x <math><mi>a</mi> <mo>=</mo></math> y</p>")] == ["x a = y"]


def test_html_long_pages():
    """A page read in stretches has the labels it has when read at once."""
    net = html.trained()
    pages, _ = html.Grammar(77).sample(30)
    for a, b in zip(net.label(pages), net.label(pages, most=5), strict=True):
        assert (a == b).all()
    many = html.blocks("<article>" + "<p>word word word, and more.</p>" * 30_000 + "</article>")
    assert len(net.label([many])[0]) == 30_000


def test_html_held_out():
    net = html.trained()
    xs, ys = html.Grammar(1234).sample(150)
    got = net.label(xs)
    right = np.concatenate(got) == (np.concatenate(ys) > 0)
    assert right.mean() > 0.99


def test_html_extract(spark):
    d = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", "")], "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    assert html.extract(d).count() == 4
    got = {r.page_id: r.text for r in html.extract(d).collect()}
    assert got == {1: "A & B First bold text here. Second <tag> 5 > 3.", 2: "", 3: ""}
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html.extract(pages.limit(40)).join(pages.select("page_id", "html"), "page_id").collect():
        assert r.text == " ".join(t for p, t, _ in html.blocks(r.html) if "article" in p)
    assert html.extract(pages.limit(0)).count() == 0


# --- 6: quality -------------------------------------------------------------


def test_quality_features():
    x = quality.features(pa.array(["", None, "a", "ABC!! " * 400, "word " * 30_000, "l1\nl1\nl2", "é 語"], pa.string()))
    assert np.isfinite(x).all() and len(x) == 7
    assert (quality.features(pa.array(["a b", "c"], pa.string()))[1] == quality.features(pa.array(["c"], pa.string()))[0]).all()


def test_prior_and_risk():
    r = np.random.Generator(np.random.PCG64(0))
    good, bad = r.normal(0, 1, (3000, 5)), r.normal(3, 1, (600, 5))
    u = np.concatenate([good[1500:], bad])
    prior = quality.class_prior(good[:1500], u)
    assert 0.6 < prior < 0.76  # the truth is 0.714
    net = quality.train(good[:1500], u, prior, epochs=40)
    assert (net.logit(r.normal(0, 1, (500, 5))) > 0).mean() > 0.95 and (net.logit(r.normal(3, 1, (500, 5))) > 0).mean() < 0.05


def test_quality_held_out(spark):
    where = "/root/testdata/sf0.01"
    got = queries.op6_quality(spark, where).join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert np.mean([r.predicted for r in got if r.quality == 1]) > 0.95


def test_quality_cases(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "doc_id bigint, text string").withColumn("positive", F.lit(1))
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    net = quality.fit(d, labels)
    assert net is None and {r.score for r in quality.score(d, net).collect()} == {0.5}
    assert quality.score(d.limit(0), None).count() == 0
    named = quality.score(d.withColumn("score", F.lit("mine")), None, name="own")
    assert {(r.score, r.own) for r in named.collect()} == {("mine", 0.5)}


def test_quality_learns_from_few_ids(spark):
    """Many rows over few ids: the sample is of ids, not of rows, and one text an id is learned from."""
    d = spark.range(20_000).selectExpr("id % 7 as doc_id", "concat('some plain text number ', id) as text")
    labels = spark.createDataFrame([(i, 1) for i in range(7)], "doc_id bigint, quality int")
    assert quality.fit(d, labels) is not None


# --- 7: top-k ---------------------------------------------------------------


def brute_top(rows, k):
    ok = [(i, np.floor(1024 * np.array(v, float)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 100:
            continue
        scored = sorted((-int((a[: min(len(a), len(b))] * b[: min(len(a), len(b))]).sum()), i) for i, b in ok if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k(spark):
    r = random.Random(8)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(420)]
    rows[5:40] = [(i, [0.5] * 6) for i in range(5, 40)]  # ties
    rows[300] = (300, [0.5] * 6)
    rows[50], rows[51], rows[52], rows[53], rows[54] = (50, None), (51, [None] * 6), (52, [float("nan")] * 6), (53, [float("inf")] + [0.0] * 5), (54, [])
    rows.append((None, [1.0] * 6))
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash")).selectExpr("*", "vec_id % 100 = 0 as query")
    rows = [(x.vec_id, x.embedding) for x in d.collect()]
    for opts in ({}, {"block": 7, "rows": 40, "group": 2}):
        got = topk.top_k(d, "query", **opts).collect()
        assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in got) == brute_top(rows, 10)
    assert topk.top_k(d.limit(0), "query").count() == 0
    few = d.where("vec_id in (0, 1, 2)")
    assert topk.top_k(few, "query").count() == 2


def test_top_k_repeated_ids_and_huge_values(spark):
    """Rows sharing an id are queries and candidates of their own; terms beyond a long are ranked exactly."""
    rows = [(0, [1.0]), (0, [2.0]), *((i, [float(i)]) for i in range(1, 13))]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "vec_id % 100 = 0 as query")
    got = sorted((x["rank"], x.vec_id, x.score) for x in topk.top_k(d, "query").collect())
    want = []
    for own in (0, 1):
        scored = sorted((-1024 * 1024 * int(rows[own][1][0]) * int(v[0]), i) for k, (i, v) in enumerate(rows) if k != own)
        want += [(n, i, -s) for n, (s, i) in enumerate(scored[:10], 1)]
    assert got == sorted(want)
    huge = spark.createDataFrame([(0, [1e20, 1.0]), (1, [1e20, 0.0]), (2, [1e20, 1.0]), (3, [-1e300, 0.0]), (4, [1.7e308, 0.0]), (5, [0.0, 3.0])], "vec_id bigint, embedding array<double>").selectExpr("*", "vec_id % 100 = 0 as query")
    got = [(x["rank"], x.vec_id, x.score) for x in topk.top_k(huge, "query").orderBy("rank").collect()]
    assert [i for _, i, _ in got] == [4, 2, 1, 5, 3] and got[0][2] == 2**63 - 1 and got[-1][2] == -(2**63) and got[3][2] == 3 * 1024 * 1024


def test_top_k_meets_few_super_blocks(spark):
    """On clustered vectors a query visits few super-blocks."""
    rng = np.random.Generator(np.random.PCG64(5))
    centres = rng.normal(0, 1, (40, 16))
    x = centres[rng.integers(0, 40, 8000)] + rng.normal(0, 0.05, (8000, 16))
    d = spark.createDataFrame([(i, row) for i, row in enumerate(x.tolist())], "vec_id bigint, embedding array<double>").selectExpr("*", "vec_id % 100 = 0 as query")
    n: list = []
    got = topk.top_k(d, "query", rows=100, block=20, meetings=n).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_top(list(enumerate(x.tolist())), 10)
    print(f"{n[0]} meetings of {n[1]}")
    assert n[0] < 0.25 * n[1]


def test_search_prunes():
    """A block whose bound is under the k-th score is not scored, and large integers stay exact."""
    q, data = np.array([[1, 0]]), np.array([[x, 0] for x in range(1000, 0, -1)])
    got, scored = topk.search(np.array([-1]), q, np.arange(1000), np.arange(1000), data, 3, 10)
    assert got == [(-1, 0, 0, 1000), (-1, 1, 1, 999), (-1, 2, 2, 998)] and scored == 1
    big = 2**40
    got, _ = topk.search(np.array([9]), np.array([[big]]), np.arange(2), np.array([0, 1]), np.array([[big], [big + 1]]), 1, 1)
    assert got == [(9, 1, 1, big * (big + 1))]


# --- 8: substring dedup -----------------------------------------------------


def brute_substring(docs, k):
    first = {}
    for d, w in docs:
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in docs:
        dead = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                dead[i : i + k] = [True] * k
        kept = [x for x, y in zip(w, dead, strict=True) if not y]
        out.append((d, len(w), sum(dead), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("width", [50, 6])
def test_substring(spark, width):
    texts = corpus(70, 7)
    ids = list(range(len(texts)))
    random.Random(0).shuffle(ids)
    d = frame(spark, texts, ids).withColumns({"lo": F.lit(1), "anchor": F.lit("x"), "first": F.lit(2)})
    got = substring.dedup(d, width=width).collect()
    want = brute_substring([(i, words(t)) for i, t in zip(ids, texts, strict=True)], width)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    for r in got:
        own, dead = words(texts[ids.index(r.doc_id)]), {k for s in r.spans for k in range(s["start"], s["end"])}
        for f in r.factors:
            assert f["reference"] < r.doc_id and set(range(f["start"], f["end"])) <= dead and f["end"] - f["start"] >= width
            ref = words(texts[ids.index(f["reference"])])
            first = own[f["start"] : f["start"] + width]
            assert any(ref[k : k + width] == first for k in range(len(ref)))
        assert sum(s["end"] - s["start"] for s in r.spans) == r.n_removed and hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_substring_cases(spark):
    assert substring.dedup(frame(spark, [])).count() == 0
    long = " ".join(map(str, range(60)))
    d = spark.createDataFrame([(1, long), (1, long), (None, long), (2, long), (2, "short")], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring.dedup(d, texts=False).collect()), key=str)
    assert got == sorted([(1, 60, 0), (1, 60, 0), (None, 60, 0), (2, 60, 60), (2, 1, 0)], key=str)
    one = {r.doc_id: r for r in substring.dedup(frame(spark, [long, "x " * 5000 + long, "x " * 3000])).collect()}
    assert one[1].n_removed == 60 and one[2].n_removed == 3000 and one[2].factors == [(0, 3000, 1)]


# --- 9: ogg -----------------------------------------------------------------


def plain_crc(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc


@given(st.binary(max_size=300))
@settings(max_examples=40, deadline=None)
def test_ogg_checksum(data):
    assert ogg.checksum(data) == plain_crc(data)


@pytest.mark.parametrize("n", [1, 2, 85, 86, 200, 3000])
@pytest.mark.parametrize("unit", [576, 255, 510, 100])
def test_ogg_round_trip(n, unit):
    payload = random.Random(n).randbytes(n * unit)
    media = ogg.write(payload, unit)
    back, info = ogg.samples(media)
    assert back == payload and info["packets"] == n and info["streams"] == 2 and info["seconds"] == len(payload) / 8000
    times = next(s.times for s in ogg.read(media).values() if len(s.packets) == n + 1)
    assert times[-1] == len(payload) and all(a <= b for a, b in zip([t for t in times if t >= 0], [t for t in times if t >= 0][1:], strict=False))


def test_ogg_faults():
    media = ogg.write(bytes(576 * 400))
    for bad in (media[:-1], media[:60] + b"X" + media[61:], media[10:], media + b"OggS", media.replace(b"OggS", b"OggX", 1)):
        with pytest.raises(ogg.OggError):
            ogg.samples(bad)
    pages = re.split(b"(?=OggS)", media)[1:]
    with pytest.raises(ogg.OggError):
        ogg.samples(b"".join([*pages[:3], *pages[4:]]))


def test_ogg_media(spark):
    texts = corpus(20) + ["é" * 1000]
    got = {r.doc_id: r for r in ogg.media(frame(spark, texts).withColumn("media", F.lit(1))).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (576 if not raw else -len(raw) % 576)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.media_bytes == len(r.media) and r.media_sha256 == hashlib.sha256(r.media).hexdigest() and ogg.samples(bytes(r.media))[0] == payload
    assert ogg.media(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id bigint, text string")).count() == 2
    for i, t in enumerate(texts):
        x = [b - 128 for b in ((t or "").encode() + b"\xff" * (got[i].payload_bytes - got[i].n_bytes))]
        mean, rms = sum(x) / len(x), (sum(v * v for v in x) / len(x)) ** 0.5
        said = dict(part.split("=") for part in got[i].feature.split(";"))
        assert abs(float(said["mean"]) - mean) < 1e-3 and abs(float(said["rms"]) - rms) < 1e-3 and int(said["crossings"]) == sum((a >= 0) != (b >= 0) for a, b in zip(x, x[1:], strict=False))
        assert int(said["packets"]) == len(x) // 576 and float(said["seconds"]) == pytest.approx(len(x) / 8000, abs=1e-6)
    assert got[4].media_sha256 == got[5].media_sha256 and got[4].feature == got[5].feature
    assert ogg.media(frame(spark, [])).count() == 0


# --- 10: line dedup ---------------------------------------------------------


def brute_lines(docs, k=6, least=0.8):
    rows = [(d, i, x) for d, t in docs for i, line in enumerate((t or "").split("\n")) if (x := line.strip(" \t\r\f\v"))]
    own = list(dict.fromkeys(x for _, _, x in rows))
    sets = [frozenset(x[i : i + k] for i in range(max(1, len(x) - k + 1))) for x in own]
    parent = list(range(len(own)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= least * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    first, gone = {}, defaultdict(set)
    place = {x: i for i, x in enumerate(own)}
    for d, i, x in sorted(rows):
        if first.setdefault(find(place[x]), (d, i)) != (d, i):
            gone[d].add(i)
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in docs}


def test_line_dedup(spark):
    r = random.Random(13)
    line = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(r.randrange(4, 30)))
    pool = [line() for _ in range(40)]
    pool += [x[:-1] + "!" for x in pool[:12]] + ["  " + x + "\t" for x in pool[12:16]] + ["ab", "ab", "", "   ", "é" * 9]
    docs = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(1, 8)))) for i in range(60)] + [(60, None), (61, ""), (62, "\n\n"), (63, line() * 300)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"pos": F.lit(1), "line": F.lit("x"), "gone": F.lit(2)})
    got = {x.doc_id: x for x in lines.dedup(d).collect()}
    assert {i: x.text for i, x in got.items()} == brute_lines(docs)
    assert all(x.pos == 1 and x.line == "x" for x in got.values())
    assert got[60].n_lines == 0 and sum(x.n_removed for x in got.values()) > 100
    assert lines.dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_line_dedup_in_a_crowded_bucket(spark, monkeypatch):
    """Lines of one template share buckets; a near copy is found though neither line is near the bucket's least or greatest node."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 9)))
    shared, docs = [word() for _ in range(40)], []
    for i in range(600):
        own = [word() for _ in range(7)]
        at = sorted(r.sample(range(40), 7))
        for copy in (own, [*own[:6], own[6][:-1] + "#"]):
            text = list(shared)
            for k, w in zip(reversed(at), reversed(copy), strict=True):
                text.insert(k, w)
            docs.append((len(docs), " ".join(text)))
    want = brute_lines(docs)
    # Several blocks a bucket.
    monkeypatch.setattr(lines, "BLOCK", 100, raising=False)
    got = {x.doc_id: x.text for x in lines.dedup(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    removed = {i for i, t in want.items() if t == ""}
    found = {i for i, t in got.items() if t == ""}
    assert len(removed) >= 600 and found <= removed
    assert len(found) >= 0.99 * len(removed), f"{len(found)} of {len(removed)}"


def test_line_dedup_in_groups_of_distant_copies(spark):
    """Groups of a line and one to nine variants of it at Jaccard 0.80 to 0.86: the share of all lines that should go, and do."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 9)))
    grams = lambda t: {t[i : i + 6] for i in range(max(1, len(t) - 5))}
    docs = []
    for k in range(120):
        base = [word() for _ in range(r.randrange(30, 90))]
        docs.append(" ".join(base))
        for _ in range(1 + k % 9):
            own, low = list(base), grams(" ".join(base))
            while True:
                own[r.randrange(len(own))] = word()
                new = grams(" ".join(own))
                j = len(low & new) / len(low | new)
                if j < 0.8:
                    own = list(base)
                elif j <= 0.86:
                    break
            docs.append(" ".join(own))
    order = list(range(len(docs)))
    r.shuffle(order)
    rows = [(i, docs[k]) for i, k in enumerate(order)]
    want = {i for i, t in brute_lines(rows).items() if t == ""}
    got = {x.doc_id for x in lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if x.n_removed}
    print(f"found {len(got)} of {len(want)} lines in groups")
    assert got <= want and len(got) >= 0.95 * len(want), f"{len(got)} of {len(want)}"


def test_line_dedup_cases(spark):
    """Repeated rows, null ids, counts and columns of the same names."""
    d = spark.createDataFrame([(1, "one line here\nother line there"), (1, "one line here\nother line there"), (None, "one line here"), (2, "one line here\r\n\t"), (3, "\U0001f600 " * 9)], "doc_id bigint, text string").withColumn("n_removed", F.lit(-5))
    got = sorted(((x.doc_id, x.text, x.n_lines, x.n_removed) for x in lines.dedup(d).collect()), key=str)
    assert got == sorted([(1, "one line here\nother line there", 2, 0)] * 2 + [(None, "one line here", 1, 0), (2, "\t", 2, 1), (3, "\U0001f600 " * 9, 1, 0)], key=str)
    named = lines.dedup(d, counts=("a", "b")).collect()
    assert {x.n_removed for x in named} == {-5} and sum(x.b for x in named) == 1


def test_line_dedup_is_native(spark):
    plan = lines.gone(frame(spark, ["a b c d e f g"] * 3))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- pipeline ---------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frame_, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        frame_ = stage(spark, frame_, SF).checkpoint() if name else frame_
        assert frame_.columns == docs.columns
        sizes.append(frame_.count())
    assert sizes[0] <= docs.count() and sizes[1] <= sizes[0] and sizes[2] <= sizes[1]
    texts = frame_.collect()
    assert all(r.n_chars == len(r.text) for r in texts)
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.agg(F.sum("length")).first()[0] == sum(len(packing.encoder(queries.vocabulary())(r.text)) + 1 for r in texts)


def test_pipeline_cases(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns, an empty table."""
    import corpus_pipeline

    long = " ".join(f"w{i % 997}" for i in range(20_000))
    plain = "One plain sentence that stands here on its own, without any trouble."
    rows = [(1, plain, "en", "a", 3), (1, plain, "en", "a", 3), (2, None, "en", "a", None), (3, "", None, None, 0), (None, "A text whose row has no id at all.", "en", "b", 1), (4, long, "fr", None, 9), (5, plain, "en", "b", 2), (6, "x\ny\n\nz", "en", "b", 7)]
    clash = {c: F.lit(1) for c in ("score", "gone", "copies", "rid", "node", "n_lines", "n_removed", "root", "row", "size", "bitmap", "key", "pos")}
    docs = spark.createDataFrame(rows, DOCS).withColumns(clash)
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 1, None), (6, None, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, d in (("all", docs), ("none", docs.limit(0))):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            where = str(tmp_path / f"{k}-{name}")
            out = stage(spark, d, str(tmp_path))
            if k < 4:
                assert out.columns == d.columns or set(out.columns) == set(d.columns)
            out.write.parquet(where)
            d = spark.read.parquet(where)
    for k in range(4):
        stage = spark.read.parquet(str(tmp_path / f"{k}-all"))
        assert stage.count() > 0 and all(r[c] == 1 for r in stage.collect() for c in clash), corpus_pipeline.STAGES[k][0]
    kept = [r.doc_id for r in spark.read.parquet(str(tmp_path / "2-all")).collect()]
    assert kept.count(1) == 1 and 5 not in kept and None in kept and 4 in kept


def test_cut_leaves_no_shuffle_files(spark):
    """What a plan shuffled goes when it has been written, not when the driver happens to collect its garbage."""
    from pathlib import Path

    from corvane.llm._spark import cut

    tops = [str(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for top in tops for f in Path(top).rglob("shuffle_*")}
    before = files()
    own = cut(spark.range(10_000).selectExpr("id % 1000 as k", "id").groupBy("k").agg(F.max("id").alias("m")).repartition(4, "m"))
    assert files() <= before
    assert own.count() == 1000 and own.agg(F.min("m")).first()[0] == 9000


def test_quality_gathers_features_in_four_bytes(spark):
    """The driver holds two copies of the features and an order of them, not lists and eight bytes a value."""
    import tracemalloc

    x = F.transform(F.sequence(F.lit(1), F.lit(249)), lambda j: (F.xxhash64("id", j) % 1000).cast("float"))
    rows = spark.range(8000).select((F.col("id") % 4 == 0).alias("positive"), x.alias("x"))
    tracemalloc.start()
    p, u = quality._gathered(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert p.shape == (2000, 249) and u.shape == (6000, 249) and p.dtype == u.dtype == np.float32
    assert (np.diff(u[:, 0]) >= 0).all() and peak < 3 * 4 * 8000 * 249, peak
    assert [len(y) for y in quality._gathered(rows.limit(0))] == [0, 0]


def test_line_sets_are_byte_ranges(spark):
    """Shingles are hashed as ranges of two bytes a character, the same ones in lines of any script, with and without characters of two units."""
    texts = ["ab", "abcdef", "abcdefg", "éa b c d " * 9, "plain words and no more " * 20, "\U0001f600 plain words and no more " * 3, "plain words and no more \U0001f600" * 20]
    sets = [{t[i : i + 6] for i in range(max(1, len(t) - 5))} for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, line string").select("i", F.array_distinct(lines._set("line", 6)).alias("s"))
    got = {r.i: set(r.s) for r in rows.collect()}
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert len(got[a] & got[b]) == len(sets[a] & sets[b]), (a, b)
    hashed = {r.h for r in spark.createDataFrame([(x,) for x in sets[4]], "x string").select(F.xxhash64(F.encode("x", "UTF-16BE")).alias("h")).collect()}
    assert got[4] == hashed


def test_line_dedup_lets_joined_components_leave_once(spark):
    """A line near to all thirty of a component is one row, not thirty."""
    texts = [("a line that many others come very near to, with a number at its end " * 4) + str(i) for i in range(31)]
    all_ = spark.createDataFrame(list(enumerate(texts)), "k1 bigint, line string")
    member = all_.select(F.lit(5).cast("bigint").alias("key"), "k1", F.when(F.col("k1") < 30, 0).otherwise(F.col("k1")).cast("bigint").alias("root"))
    got = lines._others(member, lines.signatures(all_, 8), all_, 6, 0.8).collect()
    assert [tuple(r) for r in got] == [(0, 30)]
