"""Odd rows, empty tables and brute force for every operator of the subpackage."""

import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sheafwork.llm import html_extract, langid, licenses, mixing, packing, sharding, simhash, topics, topk, toxicity, webp

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Names that the operators use inside, as columns of the input.
CLASHING = "fp key node part rank size shard slot digest start tokens topic weight draw score component length bytes n chunk own_tokens own_keep_id"
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING.split())


def rows(seed=3):
    g = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "naïve", "x", "Ünder", "<|endoftext|>"]
    texts = [" ".join(g.choice(words) for _ in range(g.randrange(1, 60))) for _ in range(30)]
    texts += [None, "", "   ", "\n\t", "a  b \x00 c", texts[0], texts[0], texts[1].upper(), "Released under the MIT License.", " ".join(g.choice(words) for _ in range(9000)), "é" * 5000]
    out = [(k, t, g.choice(["en", "de", None]), g.choice(["s", None]), 1) for k, t in enumerate(texts)]
    out += [(None, texts[2], "en", "s", 1), (None, None, None, None, None), out[3], out[3]]
    return [(*r, *["z"] * len(CLASHING.split())) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), FIELDS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], FIELDS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1, k % 2) for k in range(25)] + [(3, 1, 1), (None, 0, 1), (4, None, None)], "doc_id long, quality int, toxic int")


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(BYTES)
    coder.encode_special_tokens = True
    found = packing.pack(docs, BYTES, capacity=256, keep_ids=True).collect()
    want = sorted(np.array([*coder.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for r in rows())
    whole: dict = {}
    for r in sorted(found, key=lambda r: r.piece):
        assert r.length == len(r.ids) <= 256 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.piece == 0 or r.length == 256
    for r in found:
        if r.doc_id not in (None, 3):
            whole.setdefault(r.doc_id, []).append(r)
    for own in whole.values():
        own.sort(key=lambda r: r.piece)
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own[:-1])]).tolist()
        assert np.array([i for r in own for i in r.ids], "<u4").tobytes() in want
    bins: dict = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert sum(r.length for r in found) == sum(len(w) // 4 for w in want)
    assert packing.pack(empty, BYTES).count() == 0


def test_packing_has_the_ids_of_tokenizers_by_default_settings(spark, tmp_path):
    """Through the registered query and the pipeline's stage, which read added tokens in texts as `tokenizers` does."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    from sheafwork.llm.registry import QUERIES

    coder = Tokenizer.from_file(BYTES)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext| >", "plain text", "", "é" * 3000 + " <|endoftext|>"]
    assert 50256 in coder.encode(texts[0]).ids
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for k, text in enumerate(texts):
        ids, cut = [*coder.encode(text, add_special_tokens=False).ids, 0], []
        while ids:
            cut.insert(0, ids[-2048:])
            ids = ids[:-2048]
        want |= {(k, n): (sum(map(len, cut[:n])), len(own), zlib.crc32(np.array(own, "<u4").tobytes())) for n, own in enumerate(cut)}
    for found in (QUERIES["op1_best_fit_packing"](spark, str(tmp_path)), corpus_pipeline.packed(spark, frame, "")):
        assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found.collect()} == want


def test_packing_plan_is_exact_on_small_cases():
    g = random.Random(1)
    for _ in range(60):
        items = [g.randrange(1, 21) for _ in range(g.randrange(1, 9))]
        histogram = {k: items.count(k) for k in set(items)}
        seed = max(items)
        best = max(sum(c) for c in product(*[(0, x) for x in sorted(items)[:-1]]) if sum(c) <= 20 - seed) if len(items) > 1 else 0
        chosen = packing.fullest(dict(histogram), seed, 20)
        assert sum(k * n for k, n in chosen.items()) == best + seed and all(histogram[k] >= n for k, n in chosen.items())
        segments, n = packing.plan(histogram, 20)
        assert n >= -(-sum(items) // 20)


def brute_components(prints: dict, radius: int) -> dict:
    parent = {k: k for k in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in prints:
        for b in prints:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in prints}


def plain_fingerprint(text: str) -> int:
    import re

    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, docs, empty):
    found = [r for r in simhash.near_duplicates(docs).collect()]
    prints = {r[0]: plain_fingerprint(r[1] or "") for r in rows() if r[0] is not None}
    want = brute_components(prints, 4)
    assert len(found) == len(rows())
    for r in found:
        if r.doc_id is not None:
            assert int(r.fingerprint, 16) == prints[r.doc_id] and r.component_id == want[r.doc_id]
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.representatives(docs).collect()
    assert kept[0].asDict().keys() == {*docs.columns} and len({r.doc_id for r in kept}) == len(kept)
    assert simhash.representatives(empty).count() == 0


@pytest.mark.parametrize("crowd", [4, 20_000])
def test_shards_lose_no_link(spark, crowd, monkeypatch):
    g = np.random.default_rng(5)
    centres = g.integers(0, 2**63, 40, dtype=np.uint64)
    values = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(20):
            v = c
            for b in g.integers(0, 64, g.integers(1, 6)):
                v ^= 1 << int(b)
            values.add(v)
    values = sorted(values)
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "BRUTE", 16)
    classes = spark.createDataFrame([(bytearray(v.to_bytes(8, "big")), k) for k, v in enumerate(values)], "fp binary, node long")
    links = {(r.a, r.b) for r in simhash.link(classes).collect()}
    from sheafwork.llm.components import components

    got = {k: k for k in range(len(values))} | {r.node: r.component for r in components(spark.createDataFrame(list(links), "a long, b long")).collect()}
    assert got == brute_components(dict(enumerate(values)), 4)


def test_dense_groups_inside_a_shard():
    g = np.random.default_rng(2)
    base = g.integers(0, 2**63, dtype=np.uint64)
    fp = np.array([[base ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c))] for b in range(60) for c in range(60)], dtype=np.uint64)
    a, b = simhash.shard_links(fp, np.arange(len(fp)), np.zeros(len(fp), np.int8))
    assert len(a) == len(fp) - 1 and set(b.tolist()) == {0}


@pytest.mark.parametrize("gap", [3, 5, 6, 8, 9, 12])
def test_neighbouring_dense_groups(gap):
    """Two groups whose members lie beyond the radius of each other's vantage point, but within twice of it."""
    g = np.random.default_rng(gap)
    first = [1 << int(b) for b in range(40, 60)] + [0]
    second = [((1 << gap) - 1) | x for x in first]
    values = np.array([[v] for v in dict.fromkeys(first + second)], dtype=np.uint64)
    values = values[g.permutation(len(values))]
    want = brute_components({k: int(v) for k, v in enumerate(values[:, 0])}, 4)
    for brute in (1, 16, 1 << 14):
        simhash_brute, simhash.BRUTE = simhash.BRUTE, brute
        try:
            a, b = simhash.shard_links(values, np.arange(len(values)), np.zeros(len(values), np.int8))
            half = len(values) // 2
            side = (np.arange(len(values)) >= half).astype(np.int8)
            across = simhash.Links(len(values))
            simhash.join_cross(values, np.flatnonzero(side == 0), np.flatnonzero(side == 1), across)
        finally:
            simhash.BRUTE = simhash_brute
        got = {k: k for k in want} | dict(zip(a.tolist(), b.tolist(), strict=True))
        assert got == want
        for x in range(half):
            for y in range(half, len(values)):
                if bin(int(values[x, 0] ^ values[y, 0])).count("1") <= 4:
                    assert across.root(x) == across.root(y)


def test_wide_fingerprints_catch_near_copies(spark):
    g = random.Random(7)
    words = [f"w{k}" for k in range(4000)]
    base = [[g.choice(words) for _ in range(400)] for _ in range(12)]
    near = [[w if k != 100 and k != 300 else "changed" for k, w in enumerate(b)] for b in base]
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(base + near)], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.representatives(frame).collect()) == list(range(12))


@pytest.mark.parametrize("part", [1000, 3])
def test_components_of_stars(spark, part, monkeypatch):
    """Large stars, some of them joined, by a broadcast of their centres and by joins alone."""
    from sheafwork.llm import components as module

    monkeypatch.setattr(module, "PART", part)
    g = random.Random(part)
    links = [(1000 * c + g.randrange(1, 400), 1000 * c) for c in range(3) for _ in range(300)] + [(2000, 1005), (9001, 9002)] + [(5000 + k, 5000 + g.randrange(k)) for k in range(1, 60)]
    parent = {x: x for pair in links for x in pair}
    for _ in range(70):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.component for r in module.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == parent


def test_components_of_a_long_chain(spark):
    from sheafwork.llm.components import components

    links = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_sharding(spark, docs, empty):
    found = sharding.shard_by_bytes(docs, shards=4).collect()
    texts = {r[0]: r[1] or "" for r in rows()}
    assert len(found) == len(rows())
    for r in found:
        if r.doc_id is not None:
            assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    for s in range(4):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    sizes = [r["b"] for r in sharding.shard_by_bytes(many).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 0.03 * max(sizes)
    assert sharding.shard_by_bytes(empty).count() == 0


def brute_licenses(texts: dict) -> dict:
    out = {}
    for t in licenses.prepared():
        for doc_id, text in texts.items():
            words = licenses.words_of(text or "")
            for q in range(0, len(words), t["step"]):
                window = words[q : q + t["window"]]
                has = {" ".join(window[k : k + t["size"]]) for k in range(len(window) - t["size"] + 1)}
                part = len(has & set(t["shingles"])) / len(t["shingles"])
                if part >= 0.8:
                    out[doc_id, t["template"]] = max(part, out.get((doc_id, t["template"]), 0))
    return out


def test_license_scan(spark, docs, empty):
    g = random.Random(4)
    filler = lambda n: " ".join(g.choice(["general", "software", "licensed", "foo", "bar", "version"]) for _ in range(n))
    texts = {}
    for k, (_, template) in enumerate(licenses.TEMPLATES):
        texts[10 * k] = f"{filler(37 + k)} {template.upper()} {filler(50)}"
        words = template.split()
        words[len(words) // 2] = "altered"
        texts[10 * k + 1] = f"{filler(11)} {' '.join(words)}"
    texts |= {900: None, 901: "", 902: filler(3000)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.template): r.containment for r in licenses.scan(frame).collect()}
    assert got == brute_licenses(texts)
    assert {r.license for r in licenses.scan(docs).collect()} == {"MIT"}
    assert licenses.scan(empty).count() == 0


def test_bands_keep_the_chance_of_a_miss_small():
    for t in licenses.prepared():
        shared = -(-8 * len(t["shingles"]) // 10)
        similarity = shared / (t["window"] - t["size"] + 1 + len(t["shingles"]) - shared)
        assert (1 - similarity) ** t["bands"] <= licenses.MISS * 1.001


PAGE = '<html><head><title>no</title><style>p{}</style></head><body><header>Site</header><nav><a href="/">Home</a> <a>News</a></nav><div class="cookie-banner">We use cookies.</div><article><h1>A &amp; B</h1><p>First <b>para</b>graph&nbsp;of\n the text, long enough to be the main one of all.<p>Short.<br>Next<script>var x = "</p>";</script></article><aside>Read more here</aside><div id="comments"><p>Nice text, I liked it very much indeed, thank you all.</div><form>Name</form><footer>&copy; me</footer>'


def test_html(spark):
    fields = "page_id long, url string, html string, text string, n_chars string"
    pages = spark.createDataFrame([(1, "u", PAGE, "z", "z"), (2, None, None, "z", "z"), (None, "u", "", "z", "z"), (4, "u", "<p>unclosed <b>and < stray &am; &#x41; text here", "z", "z"), (1, "u", PAGE, "z", "z")], fields)
    got = html_extract.extract(pages).collect()
    assert [r.text for r in got][:4] == ["A & B First paragraph of the text, long enough to be the main one of all. Short. Next", "", "", "unclosed and < stray &am; A text here"]
    assert all(r.n_chars == len(r.text) for r in got) and got[0] == got[4]
    assert html_extract.extract(spark.createDataFrame([], fields)).count() == 0


ARTICLE = "<h1>A dry summer</h1><p>The river fell to its lowest level since the gauge by the mill was set up a hundred years ago.<p>Boats lie on the sand, and the ferry has stopped, the council said on Monday evening."
MAIN = "A dry summer The river fell to its lowest level since the gauge by the mill was set up a hundred years ago. Boats lie on the sand, and the ferry has stopped, the council said on Monday evening."
NAV = "<nav><a>Home</a> <a>World</a></nav>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id=aspnetForm>{NAV}<article>{ARTICLE}</article><footer>All rights reserved by us</footer></form></body>",
        f"<body><form id=aspnetForm>{NAV}<div>{ARTICLE}</div><footer>All rights reserved by us</footer></form></body>",
        f"<body class='has-sidebar'>{NAV}<article>{ARTICLE}</article><aside>Read more here</aside></body>",
        f"<body>{NAV}<div class='content-sidebar-wrap'><main>{ARTICLE}</main><div class='sidebar'><p>Our cook has written nine books about soups and stews.</div></div></body>",
        f"<body><div class='page-header-wrap'>{NAV}<div class='content'>{ARTICLE}</div></div></body>",
        f"<body><div class='related-topics'>{NAV}<main>{ARTICLE}</main></div></body>",
        f"<body>{NAV}<article>{ARTICLE}</article><div class='related'><article><p>Library gets new shelves and a reading room for all the children of the town.</article></div></body>",
        *[f"<body>{NAV}<article>{tag}{ARTICLE}</article></body>" for tag in ("<svg/>", "<iframe src='x' />", "<object data='x'/>", "<video-player>", "<button>", "<script src='x'/>")],
        f"<body>{NAV}<button><article>{ARTICLE}</article><button>Send</button></body>",
        f"<body>{NAV}<article>{ARTICLE}</article><script>unclosed = 1; <p>no text of the page, but a part of a script that never ends",
    ],
)
def test_html_loses_no_article(page):
    assert html_extract.main_text(page) == MAIN


AD = "Buy our shoes now, for every weather and at half the price, this week only in all our shops"


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{NAV}<article>{ARTICLE}<p class='advert'>{AD}</p></article></body>",
        f"<body>{NAV}<article><p hidden>{AD}</p>{ARTICLE}</article></body>",
        f"<body>{NAV}<article>{ARTICLE}<span hidden>{AD}</span></article></body>",
        f"<body>{NAV}<article>{ARTICLE}<span class=ad>Ad: <span>{AD}</span>!</span></article></body>",
        f"<body>{NAV}<article>{ARTICLE}<p aria-hidden=true>{AD}</p><p style='display: none'>{AD}</article></body>",
        f"<body>{NAV}<div class='entry'>{ARTICLE}<h3 class='comments'>Reader comments</h3><p>Nice read, I liked it very much, thank you all for that.</div></body>",
        f"<body>{NAV}<div>{ARTICLE}<h3>12 Comments</h3><p>Nice read, I liked it very much, thank you all for that.</div></body>",
        f"<body>{NAV}<div>{AD}</div><article>{ARTICLE}</article></body>",
        f"<body>{NAV}<article>{ARTICLE}</article><p title='never closed>{AD}</body>",
        f"<body>{NAV}<article class=\"x>{ARTICLE}</article></body>",
        f"<body><p><a>Home</a> <a>News</a></p><div>{ARTICLE}</div><p><a>Next</a><p>Visitors: 12<p><a>Mail</a></body>",
    ],
)
def test_html_leaves_out_what_is_no_article(page):
    assert html_extract.main_text(page) == MAIN


@pytest.mark.parametrize("page", ["<a " * 350_000, '<a x="' * 170_000, "<iframe>" * 130_000, "<svg>" * 200_000, "<p <p " * 170_000, "<span hidden>" * 80_000, '<p class="a' * 100_000, "&am;" * 250_000, "<" * 1_000_000])
def test_html_takes_time_in_proportion(page):
    import time

    begun = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - begun < 10  # some 0.5 s on a machine at rest; the quadratic reader took hours


def test_html_tree_judges_by_words_and_links_of_neighbours():
    used = set()

    def walk(node):
        if isinstance(node, tuple):
            used.add(html_extract.FEATURES[node[0]])
            walk(node[2])
            walk(node[3])

    walk(html_extract.tree())
    assert html_extract.FEATURES[html_extract.tree()[0]] == "link density"
    assert used >= {"words", "link density", "words before", "link density before", "words after", "link density after"}


def plain_blocks(page: str) -> list[str]:
    """Blocks by the standard library's parser."""
    from html.parser import HTMLParser

    out: list[list[str]] = [[]]

    class Reader(HTMLParser):
        skipping = 0

        def handle_starttag(self, tag, attrs):
            self.skipping += tag in ("script", "style")
            if tag in html_extract.BLOCKS:
                out.append([])
            elif tag == "br":
                out[-1].append(" ")

        def handle_endtag(self, tag):
            self.skipping -= tag in ("script", "style")
            if tag in html_extract.BLOCKS:
                out.append([])

        def handle_data(self, data):
            if not self.skipping:
                out[-1].append(data)

    reader = Reader()
    reader.feed(page)
    reader.close()
    return [" ".join(t.split()) for t in map("".join, out) if t.split()]


def test_html_blocks_by_another_parser():
    g = random.Random(11)
    texts = ["one two", "a &amp; b", "&#65;&eacute;", " ", "x&nbsp;y", "1 < 2 ", "\n\t", "z"]

    def make(depth):
        out = ""
        for _ in range(g.randrange(1, 5)):
            kind = g.choice(["text", "div", "p", "b", "ul", "br", "comment", "script", "quoted"])
            inner = make(depth - 1) if depth else g.choice(texts)
            out += {"text": g.choice(texts), "div": f"<div data-x=1>{inner}</div>", "p": f"<p>{g.choice(texts)}</p>", "b": f"<b>{g.choice(texts)}</b>", "ul": f"<ul><li>{g.choice(texts)}</li><li>{inner}</li></ul>", "br": "<br/>"}.get(
                kind, {"comment": "<!-- <p>no</p> -->", "script": "<script>var a = '<p>';</script>", "quoted": "<i title='a > b' lang=\"<p>\">q</i>"}.get(kind, "")
            )
        return out

    for _ in range(300):
        page = f"<body>{make(3)}</body>"
        assert [t for t, _ in html_extract.blocks(page)] == plain_blocks(page), page


def test_html_on_the_tables(spark, sf_dir):
    import html as unescape
    import re

    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        assert html_extract.main_text(r.html) == " ".join(unescape.unescape(re.sub(r"<[^>]*>", " ", article)).split())


def test_toxicity(spark, docs, labels, empty, monkeypatch):
    found = toxicity.score(docs, labels).collect()
    assert len(found) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    by_text: dict = {}
    texts = {r[0]: r[1] for r in rows()}
    for r in found:
        if r.doc_id is not None:
            by_text.setdefault(texts[r.doc_id], set()).add(r.score)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert all(max(v) - min(v) < 1e-5 for v in by_text.values())
    assert {r.score for r in toxicity.score(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.score(empty, labels).count() == 0
    assert toxicity.accepted(docs, labels).columns == docs.columns


def test_toxicity_learns_one_text_of_a_repeated_id_whatever_the_order(spark):
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    made = [(k, f"text {k} of many", k % 2) for k in range(60)] + [(k, f"another text {k}", k % 2) for k in range(60)] + [(7, "x" * (toxicity.CHARACTERS // 20 + 1), 1), (8, None, 0)]
    found = []
    for order in (made, made[::-1]):
        frame = spark.createDataFrame(order, "doc_id long, text string, toxic int").repartition(1 + len(found))
        found.append(toxicity.sample(frame, frame.select("doc_id", "toxic")))
    assert found[0] == found[1] and len(found[0][0]) == 60 - sum(k < 60 for k in held)
    few = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    assert sorted(toxicity.sample(few, few.select("doc_id", "toxic"), size=3)[1]) == [0, 0, 0, 1, 1, 1]


def test_toxicity_gradients():
    net = toxicity.Network.fresh(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) * (5 if k in ("words", "grams") else 1) for k, v in net.p.items()}
    gates = net.gates(net.inputs(["a", "b", "c", "dd"]))
    ids, y = np.array([[0, 1, 2, 3, 0, 1], [1, 2, -1, -1, -1, -1], [-1] * 6]), np.array([1, 0, 1.0])
    _, grad, d_gates = net.gradients(gates, ids, y)

    def slope(array, at):
        before, step = array[at], 1e-5
        array[at] = before + step
        up = net.gradients(gates, ids, y)[0]
        array[at] = before - step
        down = net.gradients(gates, ids, y)[0]
        array[at] = before
        return (up - down) / 2 / step

    for name in ("attend", "out", "u_ahead", "u_back"):
        at = (0,) * net.p[name].ndim
        assert abs(slope(net.p[name], at) - grad[name][at]) < 1e-6
    for at in ((0, 1), (1, 9), (2, 20), (3, 40)):
        assert abs(slope(gates, at) - d_gates[at]) < 1e-6


def test_toxicity_held_out(spark):
    own = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    got = toxicity.score(own, own.select("doc_id", "toxic")).where("held_out").join(own.select("doc_id", "toxic"), "doc_id").toPandas()
    assert len(got) > 500 and (got.predicted == got.toxic).mean() > 0.94
    s, y = got.score.to_numpy(), got.toxic.to_numpy()
    assert np.mean(s[y == 1][:, None] > s[y == 0][None, :]) > 0.93


def test_windows_reach_every_word():
    for n in (0, 1, 23, 24, 25, 40, 41, 999):
        cut = toxicity.cut(np.arange(n))
        assert set(cut[cut >= 0].tolist()) == set(range(n))


def test_top_k(spark, monkeypatch):
    g = np.random.default_rng(1)
    rows_ = [(k, [float(x) for x in g.integers(-3, 4, 4) / 8 * (1 + k % 3)], "z") for k in range(160)]
    rows_ += [(160, [1.0, None, 0.0, 0.0], "z"), (180, [float("nan")] * 4, "z"), (200, None, "z"), (None, [1.0] * 4, "z"), (220, [float("inf")] * 4, "z"), (240, [0.1, 0.2], "z"), (241, [-0.3, 0.2], "z"), (260, [0.0] * 4, "z"), rows_[7], (280, [], "z")]
    monkeypatch.setattr(topk, "CHUNK", 30)
    monkeypatch.setattr(topk, "BLOCK", 3)
    monkeypatch.setattr(topk, "STEEP", 0.4)
    frame = spark.createDataFrame(rows_, "vec_id long, embedding array<double>, score string")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(frame, k=5).collect()}
    sound = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v, _ in rows_ if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = {}
    for i, v in sound:
        if i % 20 == 0:
            scores = sorted((-int(v @ w), j) for j, w in sound if j != i and len(w) == len(v))[:5]
            want |= {(i, n): (j, -s) for n, (s, j) in enumerate(scores, 1)}
    assert got == want
    assert topk.top_k(frame.where("false")).count() == 0


def test_top_k_sends_a_bucket_only_where_it_may_count(spark, monkeypatch):
    """Vectors of very different lengths: after the first chunk, short buckets meet no query."""
    g = np.random.default_rng(2)
    monkeypatch.setattr(topk, "CHUNK", 50)
    monkeypatch.setattr(topk, "BLOCK", 4)
    made = []
    for k in range(800):
        v = np.abs(g.normal(size=4))
        made.append((k, [float(x) for x in v / np.linalg.norm(v) * 2.0 ** (4 - k % 8)]))
    frame = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    whole = np.array([np.floor(64 * np.array(v)) for _, v in made])
    want = {}
    for q in range(0, 800, 20):
        scores = sorted((-int(whole[q] @ whole[c]), c) for c in range(800) if c != q)[:5]
        want |= {(q, n): (c, -s) for n, (s, c) in enumerate(scores, 1)}
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(frame, k=5).collect()} == want


def test_meetings_leave_out_buckets_that_are_too_short():
    longest = {2: [(9.0, 0, 1), (3.0, 1, 2), (1.0, 2, 4)], 3: [(5.0, 0, 1)]}
    assert topk.meetings(longest, [(2, 0, 0.5), (2, 1, 2.0), (2, 2, 8.0), (3, 2, 6.0), (3, 3, float("inf"))]) == {(2, 0): (0, 2), (2, 1): (0, 1), (2, 2): (0, 0)}


def test_exact_products_of_large_numbers():
    q = np.array([[2.0**40, 1.0]])
    assert int(topk.products(q, np.array([[2.0**20 + 1, 3.0]]))[0, 0]) == 2**40 * (2**20 + 1) + 3


def test_mixing(spark, docs, empty):
    frame = spark.createDataFrame([(k, "w " * (1 + k % 5), ("en", "de", None)[k % 3], ("s", None)[k % 2]) for k in range(600)], "doc_id long, text string, lang string, source string")
    targets = {"source": {"s": 0.7, None: 0.3}, "lang": {"en": 0.5, "de": 0.2, None: 0.3}}
    found = mixing.mix(frame, targets).toPandas()
    weighted = found.tokens * found.weight
    assert abs(weighted[found.source == "s"].sum() / weighted.sum() - 0.7) < 1e-6
    assert abs(weighted[found.lang == "de"].sum() / weighted.sum() - 0.2) < 1e-6
    found = mixing.mix(docs).toPandas()
    assert len(found) == len(rows()) and ((found.draw < found.probability) == found.kept).all()
    assert abs((found.tokens * found.probability).sum() / found.tokens.sum() - mixing.SHARE) < 1e-6
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns and kept.count() == found.kept.sum()
    assert mixing.mix(empty).count() == 0 and mixing.sampled(empty).count() == 0


def test_mixing_beyond_the_drivers_cells(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 2)
    one = {(r.doc_id, r.tokens): r.probability for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "CELLS", 1)
    two = {(r.doc_id, r.tokens): r.probability for r in mixing.mix(docs).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-3 for k in one)


def test_mixing_is_the_same_beyond_the_drivers_cells(spark, monkeypatch):
    """A table that takes more than 30 rounds, and a source without a target, by the default rounds on both paths."""
    made = [("a", "en", 300), ("a", "de", 2), ("b", "en", 2), ("b", "de", 300), ("c", "en", 40)]
    frame = spark.createDataFrame([(k, "w " * n, lang, source) for k, (source, lang, n) in enumerate(made)], "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.6, "b": 0.4}, "lang": {"en": 0.48, "de": 0.52}}
    one = {r.doc_id: r for r in mixing.mix(frame, targets, F.lit("t")).collect()}
    monkeypatch.setattr(mixing, "CELLS", 1)
    two = {r.doc_id: r for r in mixing.mix(frame, targets, F.lit("t")).collect()}
    assert one.keys() == two.keys() == set(range(5)) and one[4].probability == two[4].probability == 0
    assert all(abs(one[k].weight - two[k].weight) < 1e-6 * max(1, one[k].weight) and abs(one[k].probability - two[k].probability) < 1e-6 for k in one)


def test_topics_are_those_of_the_words(spark):
    g = random.Random(9)
    fields = [[f"{stem}{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(5)] for stem in ("garden", "engine", "court")]
    made = [(k, " ".join(g.choice(fields[k % 3]) for _ in range(g.randrange(20, 60)))) for k in range(300)] + [(300, None), (301, "12 ab!"), (302, "x" * 3)]
    frame = spark.createDataFrame([(*r, "z") for r in made], "doc_id long, text string, own_topic string")
    found = {r.doc_id: r.found for r in topics.with_topic(frame, "found", topics=3).collect()}
    by_field = [{found[k] for k in range(f, 300, 3)} for f in range(3)]
    assert all(len(x) == 1 for x in by_field) and len(set.union(*by_field)) == 3 and {found[k] for k in (300, 301, 302)} == {topics.NONE}
    weight, centres = topics.learnt(frame, 3)
    for k, text in made[:40]:  # the nearest centre, computed anew
        own = topics.counts(text) * weight
        assert found[k] == f"t{int(np.argmax([own @ c for c in centres])):02d}"
    assert topics.assign(["gardenaa"], *topics.fit(np.zeros((0, topics.DIMS), np.float32))) == [topics.NONE]


def test_mixing_reads_texts_once(spark, monkeypatch):
    """Rounds read packed vectors and the topics come from the features made before; their words and tokens are those of the texts."""
    odd = [None, "", " ", "\t", " a\tb \n", "\nfoo bar", "x\u00a0y z", "na\u00efve\u2014caf\u00e9s \u00c9COLE\u2026done plain_word ab1cdef", "\u4e2d\u6587\u4e2d\u6587 words", "many words Many", "a  b "]
    frame = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(odd)], "doc_id long, text string, lang string, source string")
    assert mixing._token_counts([t and t.encode() for t in odd]) == [r[0] for r in frame.orderBy("doc_id").select(mixing.tokens()).collect()]
    for text in odd:
        words = topics.WORD.findall((text or "").lower())
        want = np.bincount([zlib.crc32(w.encode()) % topics.DIMS for w in words], minlength=topics.DIMS) if words else np.zeros(topics.DIMS)
        assert np.allclose(topics.counts(text), np.log1p(want))
    before = {(r.doc_id, r.topic, r.tokens, r.draw) for r in mixing.mix(mixing._drawn(frame, "own_", None, mixing.SEED).select("doc_id", "text", "lang", "source", "own_topic"), topic_col=F.col("own_topic")).collect()}

    def again(*_):
        raise AssertionError("texts are read a second time")

    monkeypatch.setattr(mixing, "with_topic", again)
    assert {(r.doc_id, r.topic, r.tokens, r.draw) for r in mixing.mix(frame).collect()} == before


def test_raking_meets_all_targets():
    g = np.random.default_rng(0)
    mass, sides = g.integers(1, 100, 60).astype(float), [np.repeat(np.arange(5), 12), np.tile(np.repeat(np.arange(4), 3), 5), np.tile(np.arange(3), 20)]
    targets = [np.array(t) / sum(t) for t in ([1, 2, 3, 4, 5], [4, 1, 1, 1], [1, 1, 3])]
    weight = mixing.rake(mass, sides, targets)
    for side, target in zip(sides, targets, strict=True):
        assert np.allclose(np.bincount(side, mass * weight) / mass.sum(), target, atol=1e-7)


def test_language_id(spark, docs, empty):
    found = langid.identify(docs, PIECES).collect()
    texts = {r[0]: r[1] for r in rows()}
    assert len(found) == len(rows())
    for r in found:
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), PIECES).collect()} == {"und"}
    assert langid.identify(empty, PIECES).count() == 0


def test_numerals_are_no_letters():
    scorer = langid.Scorer(PIECES, ["a", "b"], np.full((len(langid.Pieces(PIECES).pieces) + 1, 2), 1e-5))
    assert [n for n, _ in scorer.score(["²½", "12 _", "x²", None, ""])] == ["und", "und", "a", "und", "und"]


def test_language_held_out(spark):
    own = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(own, PIECES).where("held_out").join(own.select("doc_id", "lang"), "doc_id")
    assert got.where("lang = lang_pred").count() / got.count() > 0.98


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(PIECES)
    g = np.random.default_rng(0)
    chances = np.vstack([g.random((len(pieces.pieces), 2)), np.full((1, 2), langid.UNKNOWN)])
    index = {p: k for k, p in enumerate(pieces.pieces)}

    def total(word, language):
        if not word:
            return 1.0
        out = 0.0
        for k in range(1, len(word) + 1):
            p = index.get(word[:k])
            if p is not None or k == 1:
                out += chances[p if p is not None else -1, language] * total(word[k:], language)
        return out

    words = [langid.MARK + w for w in ("hello", "a", "übung", "ɤx", "straße")]
    got = langid.log_chances(pieces, words, chances)
    for w, row in zip(words, got, strict=True):
        assert np.allclose(np.exp(row), [total(w, 0), total(w, 1)])


def test_pieces_and_words_of_any_length():
    """No piece of lower-case letters is left out; a long word's sum is the product over parts that no piece crosses."""
    pieces = langid.Pieces(PIECES)
    assert {"translation", "▁information", "▁government"} <= set(pieces.pieces) and pieces.longest > 10
    g = np.random.default_rng(1)
    chances = np.vstack([g.random((len(pieces.pieces), 3)), np.full((1, 3), langid.UNKNOWN)])
    part = "informationtranslation" + "ɤ" * 3  # the last letter is no piece, so nothing crosses it
    one = langid.log_chances(pieces, [part], chances)[0]
    many = langid.log_chances(pieces, [part * 40], chances)[0]
    assert np.isfinite(many).all() and np.allclose(many, 40 * one)
    short = langid.MARK + "governmental"
    assert np.allclose(langid.long_forward(pieces.ends(short), chances)[-1], langid.log_chances(pieces, [short], chances)[0])


def test_fit_of_long_words_is_that_of_short_ones(monkeypatch):
    pieces = langid.Pieces(PIECES)
    counts = {"a": {langid.MARK + "translation": 3.0, langid.MARK + "straße": 1.0}, "b": {langid.MARK + "übung": 2.0}}
    _, one = langid.fit(pieces, counts)
    monkeypatch.setattr(langid, "LONGEST", 2)
    _, two = langid.fit(pieces, counts)
    assert np.allclose(one, two, rtol=1e-9)


def test_every_language_keeps_its_share_of_the_words(spark):
    """A language of few rows beside one of many words, under a bound that the latter alone would fill."""
    big = [(k, " ".join(chr(97 + k % 26) + chr(97 + j) for j in range(26)), "en") for k in range(200)]
    frame = spark.createDataFrame(big + [(k, "ilmasto sää", "fi") for k in range(1000, 1004)], "doc_id long, text string, lang string")
    counts = langid.word_counts(frame, words=40)
    assert len(counts["en"]) == 20 and set(counts["fi"]) == {langid.MARK + "ilmasto", langid.MARK + "sää"}


def test_accepted_rejects_texts_without_letters_alone(spark, docs):
    texts = {r[0]: r[1] for r in rows()}
    kept = [r.doc_id for r in langid.accepted(docs, PIECES).collect() if r.doc_id is not None]
    assert set(kept) == {k for k, t in texts.items() if k is not None and any(c.isalpha() for c in t or "")}


def test_media_round_trip(spark, docs, empty):
    found = webp.media(docs, keep_media=True, keep_pixels=True).collect()
    texts = {r[0]: r[1] for r in rows()}
    for r in found:
        if r.doc_id is not None:
            data = (texts[r.doc_id] or "").encode()
            padded = data + b" " * (-len(data) % 192 or (0 if data else 192))
            assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(data), len(padded), zlib.crc32(padded[-16:]))
            assert bytes(r.pixels)[: len(padded)] == padded and r.media_bytes == len(r.media)
    assert webp.media(empty).count() == 0


def image(transforms, pixels, codes=None, cache_bits=0):
    """A stream by hand: put(out) for each transform, then the pixels' writer."""
    out = webp.Writer()
    height, width = pixels.shape[:2]
    out.put((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3))
    return out


def file_of(out):
    data = out.bytes()
    chunk = b"VP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) % 2)
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


def gralpha(argb):
    p = webp._planes(argb.ravel())
    return p[:, [2, 1, 3, 0]]


def test_webp_transforms():
    g = np.random.default_rng(3)
    height, width = 11, 13
    want = g.integers(0, 2**32, (height, width), dtype=np.uint64).astype(np.int64)
    flat = want.ravel()
    planes = webp._planes(flat)
    # Subtract green.
    out = image([], want)
    out.put((1, 1), (webp.SUBTRACT_GREEN, 2), (0, 1))
    less = planes.copy()
    less[:, 1] -= planes[:, 2]
    less[:, 3] -= planes[:, 2]
    webp.put_pixels(out, gralpha(webp._numbers(less)), True)
    assert (webp.decode(file_of(out)) == planes[:, [1, 2, 3, 0]].reshape(height, width, 4)).all()
    # Predictor, every mode.
    for mode in range(14):
        out = image([], want)
        out.put((1, 1), (webp.PREDICTOR, 2), (0, 3))
        across, down = -(-width // 4), -(-height // 4)
        webp.put_pixels(out, gralpha(np.full(across * down, 255 << 24 | mode << 8)), False)
        out.put((0, 1))
        rest = []
        for k in range(width * height):
            y, x = divmod(k, width)
            p = planes.tolist()
            left, top, corner, right = ((p[k - d] if k >= d else None) for d in (1, width, width + 1, width - 1))
            guess = [255, 0, 0, 0] if k == 0 else left if y == 0 else top if x == 0 else expected(mode, left, top, corner, right)
            rest.append([a - b for a, b in zip(p[k], guess, strict=True)])
        webp.put_pixels(out, gralpha(webp._numbers(np.array(rest))), True)
        assert (webp.decode(file_of(out)) == planes[:, [1, 2, 3, 0]].reshape(height, width, 4)).all(), mode
    # Cross colour.
    out = image([], want)
    factors = g.integers(0, 2**24, (-(-width // 4)) * (-(-height // 4))) | 255 << 24
    out.put((1, 1), (webp.CROSS_COLOUR, 2), (0, 3))
    webp.put_pixels(out, gralpha(factors), False)
    out.put((0, 1))
    signed = lambda v: v - 256 if v > 127 else v
    changed = []
    for k, (a, r, gr, b) in enumerate(planes.tolist()):
        f = int(factors[(k // width // 4) * -(-width // 4) + k % width // 4])
        gr_r, gr_b, r_b = signed(f & 255), signed(f >> 8 & 255), signed(f >> 16 & 255)
        changed.append([a, r - (gr_r * signed(gr) >> 5), gr, b - (gr_b * signed(gr) >> 5) - (r_b * signed(r) >> 5)])
    webp.put_pixels(out, gralpha(webp._numbers(np.array(changed))), True)
    assert (webp.decode(file_of(out)) == planes[:, [1, 2, 3, 0]].reshape(height, width, 4)).all()


def expected(mode, left, top, corner, right):
    """Predictors written anew, channel by channel."""
    mean = lambda a, b: (a + b) // 2
    if mode == 11:
        guess = [x + t - c for x, t, c in zip(left, top, corner, strict=True)]
        to_left, to_top = (sum(abs(p - q) for p, q in zip(guess, side, strict=True)) for side in (left, top))
        return left if to_left < to_top else top
    out = []
    for x, t, c, r in zip(left, top, corner, right, strict=True):
        half = mean(x, t)
        out.append({0: 0, 1: x, 2: t, 3: r, 4: c, 5: mean(mean(x, r), t), 6: mean(x, c), 7: half, 8: mean(c, t), 9: mean(t, r), 10: mean(mean(x, c), mean(t, r)), 12: min(255, max(0, x + t - c)), 13: min(255, max(0, half + int((half - c) / 2)))}[mode])
    return [255, 0, 0, 0] if mode == 0 else out


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 9, 16, 17, 256])
def test_webp_palettes(colours):
    g = np.random.default_rng(colours)
    table = g.integers(0, 256, (colours, 3), dtype=np.uint8)
    pixels = table[g.integers(0, colours, (29, 31))]
    assert (webp.decode(webp.encode(pixels))[:, :, :3] == pixels).all()


def test_webp_references_and_cache():
    """Two literals, a reference to the row above, runs, cached colours, by codes of fixed length."""
    width, height, cache_bits = 8, 4, 3
    out = webp.Writer()
    out.put((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3), (0, 1))
    out.put((1, 1), (cache_bits, 4), (0, 1))
    size = 256 + 24 + (1 << cache_bits)
    lengths = np.zeros(size, np.int64)
    colours = [0xFF0A0B0C, 0xFF102030]
    slot = [(webp.CACHE_FACTOR * c & 0xFFFFFFFF) >> (32 - cache_bits) for c in colours]
    used = sorted({0x0B, 0x20, 256 + 3, 256 + 5, 280 + slot[0], 280 + slot[1]})
    spare = [k for k in range(100, 110) if k not in used][: 8 - len(used)]
    lengths[[*used, *spare]] = 3
    green = webp.canonical(lengths)
    for pair in webp.code_bits(lengths), [(1, 1), (1, 1), (1, 1), (0x0A, 8), (0x10, 8)], [(1, 1), (1, 1), (1, 1), (0x0C, 8), (0x30, 8)], [(1, 1), (0, 1), (1, 1), (255, 8)]:
        out.put(*pair)
    out.put((1, 1), (1, 1), (1, 1), (0, 8), (1, 8))  # distance prefixes 0 and 1: the pixel above, the pixel before
    literal = lambda k: out.put((int(green[(0x0B, 0x20)[k]]), 3), (k, 1), (k, 1))
    literal(0)
    literal(1)
    want = [colours[0], colours[1]]
    out.put((int(green[256 + 5]), 3), (1, 1), (1, 1))  # length prefix 5 with one extra bit: 8 pixels, from the pixel before
    want += [colours[1]] * 8
    out.put((int(green[280 + slot[0]]), 3))
    want.append(colours[0])
    while len(want) < width * height - 4:
        out.put((int(green[256 + 3]), 3), (0, 1))  # 4 pixels from the row above
        for _ in range(4):
            want.append(want[-width])
    while len(want) < width * height:
        out.put((int(green[280 + slot[len(want) % 2]]), 3))
        want.append(colours[len(want) % 2])
    got = webp.decode(file_of(out))
    assert (webp._numbers(got.reshape(-1, 4)[:, [3, 0, 1, 2]]) == np.array(want)).all()
    assert webp.plane_distances()[:4] == [(0, 1), (1, 0), (1, 1), (-1, 1)] and len(webp.plane_distances()) == 120


def coded(data: bytes) -> set[str]:
    """What the main image of a file is coded with."""
    bits, found = webp.Bits(webp._chunk(data)), set()
    bits.skip(40)
    while bits.read(1):
        kind = bits.read(2)
        found.add(("predictor", "cross", "green", "palette")[kind])
        if kind == webp.PREDICTOR:
            bits.read(3)
            webp.read_pixels(bits, 1, 1, False)
        elif kind == webp.PALETTE:
            webp.read_pixels(bits, bits.read(8) + 1, 1, False)
    bits.skip(2)
    return found | ({"references"} if webp.read_codes(bits, (280, 256, 256, 256, 40))[0].last >= 256 else set())


def test_webp_writer_chooses_what_saves_bytes():
    g = np.random.default_rng(8)
    noise = g.integers(0, 256, (20, 64, 3), dtype=np.uint8)
    grey = np.repeat(g.integers(0, 256, (90, 64, 1), dtype=np.uint8), 3, axis=2) + g.integers(0, 3, (90, 64, 3), dtype=np.uint8)
    right = np.cumsum(g.integers(0, 3, (90, 64, 3), dtype=np.uint8), axis=1, dtype=np.uint8)
    down = np.cumsum(g.integers(0, 3, (90, 64, 3), dtype=np.uint8), axis=0, dtype=np.uint8)
    copies = np.concatenate([noise, g.integers(0, 256, (3, 64, 3), dtype=np.uint8), noise, noise[5:], noise])
    far = np.concatenate([noise, np.zeros((16384 - 60, 64, 3), np.uint8), noise, noise])
    for pixels, want in ((noise, set()), (grey, {"green"}), (right, {"predictor"}), (down, {"predictor"}), (copies, {"references"}), (far, {"references"})):
        data = webp.encode(pixels)
        assert coded(data) == want
        assert (webp.decode(data)[:, :, :3] == pixels).all()


@pytest.mark.parametrize("portion", [16, 100, 1 << 15])
def test_webp_in_portions(portion, monkeypatch):
    monkeypatch.setattr(webp, "PORTION", portion)
    g = np.random.default_rng(portion)
    for text in ("word " * 700, "".join(chr(97 + int(k)) for k in g.integers(0, 26, 5000)), "é\n" * 999 + "z"):
        data, _ = webp.payload(text)
        assert webp.restore(webp.decode(webp.store(data)), len(data)) == data


def test_media_memory_of_a_long_text():
    """Some 40 bytes a byte of text."""
    import tracemalloc

    data = np.random.default_rng(0).integers(97, 123, 3_000_000, dtype=np.uint8).tobytes()
    tracemalloc.start()
    pixels = webp.decode(webp.store(data))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert webp.restore(pixels, len(data)) == data and peak < 45 * len(data)


def test_webp_rejects_broken_streams():
    data = webp.encode(np.arange(64 * 30 * 3, dtype=np.uint8).reshape(30, 64, 3))
    for broken in (b"", b"RIFF", data[: len(data) // 2]):
        with pytest.raises((ValueError, IndexError)):
            webp.decode(broken)


def test_topics_learn_from_every_document(spark):
    """Shares of words and centres are those of all documents, and the same whatever the partitions."""
    g = random.Random(3)
    fields = [[f"{name}{chr(97 + k)}" for k in range(20)] for name in ("garden", "engine", "violin", "harbor", "mirror", "saddle")]
    rows = [(k, " ".join(g.choice(fields[k % 6]) for _ in range(6))) for k in range(9000)] + [(9000, "onlyhere onlyhere"), (9001, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    weight, centres = topics.learnt(frame.repartition(3), 6)
    seen = sum((topics.counts(t) > 0).astype(np.int64) for _, t in rows)
    share = seen / len(rows)
    want = np.where((share > 0) & (share <= topics.COMMON), np.log(1 / np.maximum(share, 1e-12)), 0)
    assert np.allclose(weight, want, atol=1e-5)
    vectors = topics._unit(np.stack([topics.counts(t) for _, t in rows]) * weight)
    own = (vectors @ centres.T).argmax(axis=1)
    told = vectors.any(axis=1)
    for k in range(len(centres)):  # a centre is the mean direction of all its documents
        assert np.allclose(centres[k], topics._unit(vectors[told & (own == k)].sum(axis=0)), atol=1e-3)
    again = topics.learnt(frame.repartition(7), 6)
    assert np.array_equal(again[0], weight) and np.array_equal(again[1], centres)
