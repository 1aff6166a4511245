"""Corpus operators against brute force on small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from catalog.compare import rows_of
from histlake.llm import bpe, decontaminate, html_wrapper, language, oracle, pii, quality, simhash, substring, toxicity, url_reputation
from histlake.llm.common import connected_components, crc_mod
from histlake.llm.queries import URL_RULES, op5_url_reputation

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


# 1 toxicity


@pytest.fixture(scope="module")
def comments(spark):
    rng = random.Random(1)
    bad = ["vile", "rotten", "nasty"]
    rows = []
    for k in range(900):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(5, 60))]
        toxic = k % 4 == 0
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(bad).upper() + "!")
        rows.append((k, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5)
    return docs.select("doc_id", "text"), docs.select("doc_id", "toxic")


def test_toxicity_finds_held_out_rows(comments):
    docs, labels = comments
    held = crc_mod(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.where(~held))
    assert len(model.slots) < 2000
    found = toxicity.score(docs.where(held), model).join(labels, "doc_id").collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in found) >= 0.97 * len(found)


def test_toxicity_is_the_same_again_and_bounded(comments):
    docs, labels = comments
    a, b = (toxicity.fit(docs.repartition(n), labels.union(labels), max_rows=200) for n in (1, 7))
    assert np.array_equal(a.slots, b.slots) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_toxicity_score_equals_sum_over_features():
    text = "Ab, cd ef. ab"
    memo = toxicity.WordHashes()
    slots = np.unique(np.concatenate(toxicity.features(toxicity.words_of(text, memo))))
    assert len(slots) == 3 + 3 + 2 + 1
    model = toxicity.Model(slots, np.arange(len(slots)) / 10 - 0.3, 0.2)
    assert math.isclose(model.scorer()(text), toxicity.sigmoid(0.2 + float(model.weights.astype(np.float32).sum())), rel_tol=1e-6)


def plain_ftrl(rows, labels, share):
    """One coordinate at a time, after the published update rules."""
    z, n, bias, bias_n = defaultdict(float), defaultdict(float), math.log(share / (1 - share)), 0.0

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for slots, y in zip(rows, labels):
            w = {i: weight(i) for i in slots}
            g = 1 / (1 + math.exp(-(bias + sum(w.values())))) - y
            for i in slots:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
            bias_n += g * g
            bias -= 0.05 * g / (1 + math.sqrt(bias_n))
    return {i: weight(i) for i in z if abs(z[i]) > toxicity.L1}, bias


def test_training_equals_plain_ftrl():
    rng = random.Random(15)
    labels = [int(rng.random() < 0.4) for _ in range(400)]
    rows = [sorted({*rng.sample(range(300), 12), *([1000 + rng.randint(0, 3)] if y else [])}) for y in labels]
    slots, weights, bias = toxicity.train([np.array(r) for r in rows], labels, 0.3)
    want, want_bias = plain_ftrl(rows, labels, 0.3)
    assert dict(zip(slots.tolist(), weights.tolist())) == pytest.approx(want) and bias == pytest.approx(want_bias)
    assert any(w > 0 for k, w in want.items() if k >= 1000) and len(want) < 304


# 2 SimHash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: dict) -> dict:
    label = dict.fromkeys(fps)
    for low in sorted(fps):
        if label[low] is None:
            label[low], todo = low, [low]
            while todo:
                x = todo.pop()
                for y in fps:
                    if label[y] is None and (fps[x] ^ fps[y]).bit_count() <= 3:
                        label[y] = low
                        todo.append(y)
    return label


def test_simhash_fingerprints(awkward):
    for r in simhash.fingerprints(awkward).join(awkward.select(F.col("doc_id").alias("id"), "text").distinct(), "id").collect():
        assert r.fp % 2**64 == plain_fingerprint(r.text)


@pytest.mark.parametrize("hot", [20_000, 16])
def test_simhash_links_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_ROWS", hot)
    monkeypatch.setattr(simhash, "CELL_ROWS", 6)
    monkeypatch.setattr(simhash, "BUFFER_ROWS", 50)
    monkeypatch.setattr(simhash, "PAIRS", 100)
    rng = random.Random(3)
    fps = []
    for center in [rng.getrandbits(64) for _ in range(12)]:
        for _ in range(40):
            x = center
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randint(0, 63)
            fps.append(x)
    fps += [0, 2**64 - 1, 1 << 31, 1 << 63]
    fps = dict.fromkeys(fps)
    want = plain_components({k: k for k in fps})
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long").repartition(3)
    found = {r.node % 2**64: r.component for r in connected_components(simhash.links(df)).collect()}
    groups = defaultdict(set)
    for x in fps:
        groups[found.get(x, x)].add(x) if x in found else groups[int(np.uint64(x).view(np.int64))].add(x)
    theirs = defaultdict(set)
    for x, low in want.items():
        theirs[low].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, theirs.values()))


def test_anchor_copies_cover_every_near_pair():
    rng = random.Random(5)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(1, 3)):
            y ^= 1 << b
        rows, keys, homes = simhash.anchors_of(np.array([x, y], np.uint64))
        home_of_x = set(keys[(rows == 0) & homes].tolist())
        assert home_of_x & set(keys[rows == 1].tolist())


def test_one_per_group_keeps_the_smallest_id_once(spark):
    base = [f"t{k}" for k in range(400)]
    near = " ".join([*base[:-1], "other"])
    docs = [(5, " ".join(base)), (3, near), (9, " ".join(base)), (3, near), (7, "quite another text"), (None, "lonely words"), (2, None), (4, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((r.doc_id for r in simhash.one_per_group(df).collect()), key=str) == [2, 3, 7, None]


# 3 main text

ROW = "<html><head><title>t</title></head><body><nav><a href='/a'>Home</a></nav>{}<footer>f</footer></body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>A &amp; B</h1><p>One <b>two</b><br>three <p>four</article>", "A & B\n\nOne two three\n\nfour"),
        ("<main><p>x</p><div class='sidebar'><p>no</p></div><form><p>no</p></form>y</main>", "x\n\ny"),
        ("<article><p>x</p><section id=comments><article class=comment><p>no</p></article></section></article>", "x"),
        ("<div class='cookie-notice'>no</div><div><p>x</p><ul><li>a<li>b</ul></div><script>if (a</b) '<p>no</p>'</script>", "x\n\na\n\nb"),
        ("<article><header><h2>T</h2></header><aside>no</aside><pre> a \n  b</pre><table><tr><td>1<td>2</table></article>", "T\n\na b\n\n1\n\n2"),
        ("<!-- <article>no</article> --><article>x<!-- no -->y</article>", "xy"),
        ("", ""),
    ],
)
def test_main_text_of_one_page(body, text):
    assert html_wrapper.main_text(html_wrapper.parse(ROW.format(body)), set()) == text


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><div class='share-prices'><p>Share prices fell.</p></div><section class='related-work'>Others did it.</section></article>", "Share prices fell.\n\nOthers did it."),
        ("<article><p class='notice'>A notice was put up.</p><h2 id='comments'>Comments on the law</h2></article>", "A notice was put up.\n\nComments on the law"),
        ("<div class='search-theory'>Search</div><p><a href=x>A paragraph of links</a></p>", "Search\n\nA paragraph of links"),
        ("<article><p>x</p><div class='related-posts'>no</div><div class='ad-slot-2'>no</div><ul class='share-buttons'><li>no</ul></article>", "x"),
        ("<div class='site-footer'>no</div><div id='main-nav'>no</div><div class='pageHeader'>no</div><p>x</p>", "x"),
    ],
)
def test_class_names_mark_by_whole_names(body, text):
    assert html_wrapper.main_text(html_wrapper.parse(ROW.format(body)), set()) == text


def test_headings_of_articles_stay_however_many_pages_have_them(spark):
    for n in (7, 8, 60):
        bodies = [f"<article><h2>Ingredients</h2><p>Unique {k}</p><p>Sign up now</p></article>" for k in range(n)]
        found = extracted(spark, bodies)
        assert all(found[k].startswith(f"Ingredients\n\nUnique {k}") for k in range(n))
        assert ("Sign up" in found[0]) is (n < 8)


def test_constant_slots_become_template(spark):
    pages = [(k, f"http://h.org/{k}", f"<body><div>Menu here</div><div><p>Always the same line</p><p>Text {k} of this page</p></div></body>") for k in range(40)]
    pages += [(100, "http://other.org/", "<body><div>Menu here</div></body>"), (101, None, None), (102, "x", "<p>loose")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(7)
    found = {r.page_id: r.text for r in html_wrapper.extract(df).collect()}
    assert found[7] == "Text 7 of this page" and found[100] == "Menu here" and found[101] == "" and found[102] == "loose"


def test_copies_of_an_article_are_no_template(spark):
    html = ROW.format("<article><h1>Title</h1><p>The same article on every page.</p></article>")
    df = spark.createDataFrame([(k, "http://h.org/x", html) for k in range(50)], "page_id long, url string, html string")
    assert {r.text for r in html_wrapper.extract(df).collect()} == {"Title\n\nThe same article on every page."}


def extracted(spark, bodies, parts=5):
    pages = [(k, f"http://h.org/{k}", f"<body>{b}</body>") for k, b in enumerate(bodies)]
    return {r.page_id: r.text for r in html_wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)).collect()}


@pytest.mark.parametrize("pages, varying", [(8, 40), (40, 2), (40, 5), (4000, 5)])
def test_constant_text_among_varying_siblings(spark, pages, varying):
    bodies = ["<p>Always the same line</p>" + "".join(f"<p>Text {k} {n}</p>" for n in range(varying)) for k in range(pages)]
    assert extracted(spark, bodies) == {k: "\n\n".join(f"Text {k} {n}" for n in range(varying)) for k in range(pages)}


def test_texts_are_constant_from_95_percent_of_8_pages_on(spark):
    for pages, carry, gone in ((7, 7, False), (100, 95, True), (100, 94, False)):
        found = extracted(spark, [f"<p>{'Same line' if k < carry else f'Other {k}'}</p><p>Text {k}</p><p>More {k}</p>" for k in range(pages)])
        assert (found[0] == "Text 0\n\nMore 0") is gone, (pages, carry)


def test_no_layout_of_a_host_is_left_out(spark):
    names = [a + b for a in "qwxyz" for b in "abcdefghijklmnopqrst"]
    bodies = [f"<div class={n}><h2>About {n}</h2><p>Text {k} of {n}</p><ul><li>Item {k}</li></ul><div>Note {n}</div></div>" for n in names for k in range(8)]
    # Long pages that alternate, each in its own order, with one line at the end of all.
    rng = random.Random(3)
    bodies += ["".join(f"<{t}>{k} {j}</{t}>" for j, t in enumerate(rng.choices(("h2", "p", "pre"), k=150))) + "<div>Last line</div>" for k in range(20)]
    found = extracted(spark, bodies)
    assert found == extracted(spark, bodies, 1)
    assert [found[k] for k in range(800)] == [f"Text {k} of {n}\n\nItem {k}" for n in names for k in range(8)]
    assert all("Last line" not in found[k] and found[k].count("\n\n") == 149 for k in range(800, 820))


def test_a_block_that_only_some_pages_have_is_told_by_its_place(spark):
    bodies = [f"<div><p>Text {k}</p><pre>More</pre></div>" + "<div><p>Some pages say so</p><pre>More</pre></div>" * (k % 2) for k in range(40)]
    assert extracted(spark, bodies) == {k: f"Text {k}" for k in range(40)}


# 4 decontamination


def plain_contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        out.append((doc, len(w), len(hit), ",".join(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block, shard", [(2 << 20, 400_000), (300, 50)])
def test_contamination_equals_brute_force(spark, monkeypatch, block, shard):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    rng = random.Random(7)
    words = ["a", "B", "Éa", "c1", "d", "e"]
    items = [(k // 2, " ".join(rng.choice(words) for _ in range(rng.choice([0, 2, 5, 13, 14, 30])))) for k in range(16)] + [(90, None), (91, "?!")]
    docs = [
        (k, rng.choice([" ", ". ", "-"]).join(rng.choice([*words, "zz"]) if rng.random() < 0.6 else rng.choice(items)[1] or "q" for _ in range(rng.randint(0, 20))))
        for k in range(60)
    ]
    docs += [(61, None), docs[3], docs[3]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(df, bench).select("doc_id", "n_words", "n_hit", F.array_join(F.array_sort("items"), ","), "contaminated")
    assert sorted(map(tuple, found.collect())) == plain_contamination(docs, items)
    clean = decontaminate.clean_rows(df, bench)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == [d for d, *_, bad in plain_contamination(docs, items) if not bad]


def test_pieces_of_a_giant_item_have_its_windows():
    words = [f"w{k}".encode() for k in range(500)]
    windows = lambda w: {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    found = [decontaminate.words_of(x) for x in decontaminate.pieces(b" ".join(words), 200)]
    assert len(found) > 5 and set().union(*map(windows, found)) == windows(words)
    assert all(len(w) >= 13 and len(b" ".join(w)) <= 200 for w in found)
    assert decontaminate.pieces(b"x" * 500 + b" Y", 200) == [b"x" * 500 + b" Y"]


def test_fm_index_ranks_and_positions():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 5, 500)
    matrix = decontaminate.WaveletMatrix(text, 3)
    at, symbol = rng.integers(0, 501, 200), rng.integers(0, 5, 200)
    assert matrix.rank(symbol, at).tolist() == [int((text[:a] == s).sum()) for a, s in zip(at, symbol)]
    assert matrix.access(np.arange(500)).tolist() == text.tolist()


# 5 urls


def test_urls_equal_sql(spark):
    rng = random.Random(2)
    urls = [None, "", "nothing", "http://", "HTTP://A.Example.ORG/en/1x?y", "a://b://c", "http://com/de/", "x://org", "x://org/", "s://example.org/es/#t", "s://\u0130.com/fr/"]
    urls += [f"https://{rng.choice('ab')}{rng.randint(0, 9)}.{rng.choice(['example', 'other'])}.{rng.choice(['com', 'org', 'net'])}/{rng.choice(['de', 'fr', 'en'])}/{k}" for k in range(400)]
    urls += [f"http://bad.example.com/{rng.choice(['de', 'de', 'de', 'en'])}/{k}" for k in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_reputation.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    cursor = con.execute(oracle.URL_REPUTATION)
    rows = found.collect()
    assert rows_of(found.columns, rows) == rows_of([d[0] for d in cursor.description], cursor.fetchall())
    by_url = {urls[r.page_id]: r for r in rows}
    assert any(r.host == "bad.example.com" and r.rule is None and r.verdict == "block" for r in rows)
    assert (by_url["HTTP://A.Example.ORG/en/1x?y"].host, by_url["HTTP://A.Example.ORG/en/1x?y"].verdict) == ("a.example.org", "block")
    assert by_url["x://org"].rule is None and by_url["x://org/"].rule == "org/" and by_url["a://b://c"].host == "b:"
    assert (by_url[None].host, by_url[None].path, by_url[None].rule) == ("", "", None)


def test_suffixes_of_several_labels_part_unrelated_sites(spark):
    hosts = [("x.a.co.uk", "co.uk", "a.co.uk"), ("b.co.uk", "co.uk", "b.co.uk"), ("co.uk", "co.uk", ".co.uk"), ("c.uk", "uk", "c.uk"), ("d.e.org", "org", "e.org"), ("", "", ".")]
    df = spark.createDataFrame([(h,) for h, _, _ in hosts], "host string")
    found = {tuple(r) for r in df.select("host", *url_reputation.levels_of(F.col("host"), ["co.uk", "com.br"])).collect()}
    assert found == set(hosts)
    counts = [("x.a.co.uk", 100, 100), ("y.a.co.uk", 0, 0), ("z.b.co.uk", 50, 0), ("w.b.co.uk", 0, 0), ("v.org", 50, 25)]
    share = {r.host: r.bad_share for r in url_reputation.reputations(spark.createDataFrame(counts, "host string, n long, bad long"), ["co.uk"]).collect()}
    assert share["y.a.co.uk"] > 0.5 > share["w.b.co.uk"]


def test_urls_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/1")], "page_id long, url string")
    plan = url_reputation.judge(pages, URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


# 6 personal data


def plain_base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 16 <= len(d) <= 19 and sum(sum(divmod(x * (1 + k % 2), 10)) for k, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    parts = ["1", "22", "255", "256", ".", "@", "a.b", "+1", "+", " ", "-", "(", ")", "4539148803436467", "é", "x@y.com", "%", "000"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert plain_base(text) == pii.base_spans(text)


def test_long_digit_runs_are_linear():
    assert pii.base_spans("1" * 200_000 + "." * 5) == []


def test_pii_digests_and_added_spans(spark):
    token = "deadbeef0123456789abcdef0123456789abcdef"
    texts = [f'x token = "{token[:-2]}{k:02d}" y' for k in range(40)] + [f"mail u{k}@b.example.com or +1 (017) 555-77{k}" for k in range(10, 50)]
    texts += ["nothing", "", None, "see 4539148803436467 and 4539148803436468", "+1 (826) 555-4081 190.137.223.204"]
    rows = pii.digests(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = [f"{k}:{a}:{b}" for k, a, b in plain_base(texts[r.doc_id] or "")]
        assert r.base_sha256 == sha(",".join(base))
        assert set(base) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in pii.BASE_KINDS]
    found = {r.doc_id: r.spans for r in rows}
    assert found[3] == "secret:11:51" and found[80] == found[81] == found[82] == ""
    assert "phone:0:17" in found[84].split(",")
    assert "card:28:44" not in found[83]


def test_added_spans_have_no_largest_length(spark):
    rng = random.Random(9)
    secret = "".join(rng.choice("abcXYZ0189") for _ in range(2400))
    texts = [f'token = "{secret[:240 + k]}" end' for k in range(30)] + [f'key: "{secret}"']
    texts += [f"mail john [dot] doe{k} [at] mail [dot] example [dot] co [dot] uk" for k in range(30)]
    texts += ["iban: DE89 3704 0044 0532 0130 00", "konto GB82WEST12345698765432.", "iban: DE89 3704 0044 0532 0130 01"]
    found = {r.doc_id: r.spans for r in pii.digests(frame(spark, texts)).collect()}
    assert all(found[k] == f"secret:9:{249 + k}" for k in range(30)) and found[30] == "secret:6:2406"
    words = "mail john dot doe at mail dot example dot co dot uk"
    assert [c[:3] for c in pii.candidates(words, [])] == [("email", 5, len(words))]
    assert all(found[31 + k].split(",") == [f"email:5:{len(texts[31 + k])}"] for k in range(30))
    assert found[61] == "iban:6:33" and found[62] == "iban:6:28" and "iban" not in found[63]


def test_candidates_overlap_neither_base_spans_nor_each_other():
    rng = random.Random(4)
    parts = ["DE89370400440532013000", "a@b.com", " at ", " dot ", "xy", "12345678", " ", "+1 555 123 4567", "Ab1" * 8, "190.137.223.204", "4539148803436467", "[at]"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        base = pii.base_spans(text)
        added = [c[1:3] for c in pii.candidates(text, base) if c[3]]
        spans = [s[1:] for s in base]
        assert all(e <= a or s >= b for k, (s, e) in enumerate(added) for a, b in spans + added[:k])


def test_long_rows_of_candidates_are_read_once():
    for text in ("x dot " * 60_000, "xy at z dot " * 40_000, "AB12 " * 60_000, "a1_" * 100_000 + "/", "555 123 4567 " * 20_000):
        start = time.process_time()
        pii.candidates(text, pii.base_spans(text))
        assert time.process_time() - start < 20


def test_mask_covers_spans_and_keeps_columns(spark):
    df = frame(spark, ["to a@b.org, now", None, "", "plain"]).withColumn("spans", F.lit(1))
    out = pii.mask(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: "to <email>, now", 1: None, 2: "", 3: "plain"}
    assert pii.masked("abcdef", [("x", 1, 4), ("y", 2, 5)]) == "a<x>f"


def test_estimation_tells_good_labelers_from_bad():
    counts = np.zeros(len(pii.PATTERNS))
    for k, p in enumerate(pii.PATTERNS.tolist()):
        counts[k] = {(1, 1, 1): 500, (1, 1, 0): 300, (-1, -1, 0): 400, (-1, 0, -1): 200, (1, -1, 0): 20}.get(tuple(p), 0)
    by = dict(zip(map(tuple, pii.PATTERNS.tolist()), pii.estimate(counts)))
    assert by[1, 1, 1] > 0.99 and by[1, 1, 0] > 0.9 and by[-1, -1, 0] < 0.1 and by[-1, -1, -1] < 0.1


# 7 repeated passages


def plain_removal(docs):
    first, words = {}, [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in words:
        for s in range(len(w) - 19):
            x = tuple(w[s : s + 20])
            first[x] = min(first.get(x, (1 << 63, 0)), (d, s))
    out = []
    for d, w in words:
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (d, s):
                gone |= set(range(s, s + 20))
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("words, stretch, hot", [(2, 200, 4), (1, 1 << 20, 4), (50, 3000, 400), (400, 1 << 20, 4), (3, 1000, 4000)])
def test_removal_equals_brute_force(spark, monkeypatch, words, stretch, hot):
    monkeypatch.setattr(substring, "STRETCH_BYTES", stretch)
    monkeypatch.setattr(substring, "HOT_SHARE", hot)
    rng = random.Random(words)
    passages = [" ".join(f"w{rng.randrange(words)}" for _ in range(rng.randint(15, 60))) for _ in range(5)]
    docs = [
        (k // (1 + (words == 50)), None if k % 17 == 0 else "\n".join(rng.choice(passages) if rng.random() < 0.4 else f"w{rng.randrange(words)}" for _ in range(rng.randint(0, 60))))
        for k in range(100)
    ]
    docs.append(docs[50])
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = substring.remove(df).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, found.collect())) == plain_removal(docs)


def test_texts_of_one_id_each_have_rows_for_all_their_windows():
    passage = " ".join(f"p{k}" for k in range(60))
    found = [f"{passage} {end}".encode() for end in ("then this", "then that")]
    (_, _, place, held), _ = substring.paths(np.array([5, 5]), np.array([1, 2]), found, np.zeros(0, np.uint64))
    for tag in (1, 2):
        starts = [(int(p) >> 31) + n for p, w in zip(place, held) if int(p) & 3 == tag for n in range(len(w) // substring.HASH_BYTES)]
        assert sorted(starts) == list(range(62 - 19))


def test_texts_of_one_id_each_lose_a_passage_of_another_stretch(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    docs = [(1, f"first {passage}"), (5, f"{passage} then this"), (5, f"{passage} then that")]
    df = spark.createDataFrame(docs[:1], "doc_id long, text string").coalesce(1).union(spark.createDataFrame(docs[1:], "doc_id long, text string").coalesce(1))
    found = substring.remove(df).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, found.collect())) == plain_removal(docs)
    assert [x[3] for x in plain_removal(docs)[1:]] == ["then that", "then this"]


def test_removal_equals_brute_force_where_ids_have_several_texts(spark):
    rng = random.Random(8)
    passages = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(21, 40))) for _ in range(40)]
    piece = lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 8)))
    docs = [(rng.randrange(60), " ".join(f"{piece()} {rng.choice(passages)[rng.choice([0, 0, 9]) :]}" for _ in range(rng.randint(1, 3)))) for _ in range(240)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = substring.remove(df).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, found.collect())) == plain_removal(docs)


def equal_hash_bits(rng, bits=23):
    """Two texts of 25 words whose 64-bit hashes share their lowest bits."""
    seen = {}
    while True:
        text = " ".join(f"w{rng.randrange(10**9)}" for _ in range(25))
        h = xxhash.xxh64_intdigest(text.encode(), 42) % (1 << bits)
        if h in seen:
            return seen[h], text
        seen[h] = text


def test_texts_of_one_id_with_alike_hashes_keep_their_own_words(spark):
    one, two = equal_hash_bits(random.Random(11))
    for shared in (7, None):
        docs = [(1, one), (shared, one), (shared, two), (9, two + " end")]
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
        lost = {(r.doc_id, r.kept): r.n_removed for r in substring.remove(df).collect()}
        assert lost[1, one] == 0 and lost[shared, ""] == 25 and lost[shared, two if shared else ""] == (0 if shared else 25)
        assert lost.get((9, "end"), 0) == (25 if shared else 0)


def test_texts_of_one_id_are_numbered_without_gaps(spark):
    docs = [(1, "a"), (2, "b"), (2, "c"), (2, "c"), (2, None), (None, "d"), (None, "e"), (None, "d")]
    found = substring.numbered_texts(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), "doc_id", "text").collect()
    assert len(found) == len(docs)
    assert {(r.doc, r.tag) for r in found if r.doc == 1} == {(1, 0)}
    assert {r.tag for r in found if r.doc == 2} == {0, 1, 2} and len({r.tag for r in found if r.text == "c"}) == 1
    assert {r.tag for r in found if r.id is None} == {0, 1}
    with pytest.raises(TypeError):
        substring.remove(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_windows_are_told_apart_by_more_than_40_bits():
    words, starts = substring.word_hashes(" ".join(f"w{k}" for k in range(20)).encode())
    assert len(starts) == 20
    held = substring.paths(np.array([1]), np.array([1]), [" ".join(f"w{k}" for k in range(20)).encode()], np.zeros(0, np.uint64))[0][3]
    whole = int(substring.grams(words, 20)[0])
    assert len(held) == 1 and len(held[0]) >= 7 and int.from_bytes(held[0], "little") == whole >> 8 * (8 - len(held[0]))


def test_word_hashes_follow_the_words():
    rng = random.Random(1)
    seen = {}
    for _ in range(300):
        text = "".join(rng.choice([" ", "\t", "\x0b", "a", "b", "é", "\x1c", "\xa0"]) for _ in range(rng.randint(0, 40))).encode()
        hashes, starts = substring.word_hashes(text)
        assert len(hashes) == len(text.split())
        for h, s, w in zip(hashes.tolist(), starts.tolist(), text.split()):
            assert text[s : s + len(w)] == w and seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# 8 quality rules


def plain_signals(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>") if t else 0, len(lines) - len(set(lines)), len(covered)


def test_signals_equal_plain_counts(spark):
    rng = random.Random(4)
    texts = [None, ""] + ["".join(rng.choice(["a ", "b ", "c\n", "# ", "é\t", "\n", "a b c ", "\x1c", "\xa0"]) for _ in range(rng.randint(0, 120))) for _ in range(200)]
    for r in quality.signals(frame(spark, texts)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_signals(texts[r.id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_binomial_bound_is_exact():
    def tail(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    for n in (1, 10, 200, 600):
        for k in range(0, min(n, 12)):
            for risk, delta in ((0.02, 0.05), (0.1, 0.01)):
                assert quality.upper_bound_holds(k, n, risk, delta) == (k < n and tail(k, n, risk) <= delta)
    assert not quality.upper_bound_holds(0, 0, 0.1, 0.1)


def test_copies_of_a_text_are_one_trial(spark):
    """A good text that a cutoff would reject counts once, repeated or not; so does one
    that would make a small sample look large."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(120)) for _ in range(1800)]
    odd = " ".join(f"w{k}##" for k in range(120))
    found = []
    for more in ([], [texts[0]] * 500, [odd] * 500):
        all_texts = [*texts, odd, *more]
        marks = spark.createDataFrame([(k, 1) for k in range(len(all_texts))], "doc_id long, quality int")
        found.append(quality.cutoffs(quality.signals(frame(spark, all_texts)), marks, id_col="doc_id", label_col="quality"))
    assert found[0] == found[1] == found[2] and found[0]


def test_cutoffs_limit_false_rejection(spark):
    rng = random.Random(6)
    texts, labels = [], []
    for k in range(3000):
        good = k % 3 > 0
        words = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
        words = words if good else [w + "###" for w in words]
        texts.append(" ".join(words))
        labels.append((k, int(good)))
    df, marks = frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")
    rows = quality.judge(df, marks).collect()
    good = {k for k, q in labels if q}
    assert not any(r.kept for r in rows if r.doc_id not in good)
    assert sum(not r.kept for r in rows if r.doc_id in good) <= quality.RISK * len(good)
    assert {r.doc_id for r in quality.keep_rows(df, marks).collect()} == {r.doc_id for r in rows if r.kept}
    # Nothing is rejected beyond the base rules when there are too few labels to be sure.
    assert all(r.kept for r in quality.judge(df, marks.limit(20)).collect())


# 9 byte-level BPE


@pytest.fixture(scope="module")
def theirs():
    ranks, _ = bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("leaf_chars, leaf_bytes", [(8192, 4), (4, 1), (50, 3)])
def test_encoding_equals_the_library(monkeypatch, theirs, leaf_chars, leaf_bytes):
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf_chars)
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf_bytes)
    ranks, tokens = bpe.load_ranks(RANKS)
    rng = random.Random(leaf_chars)
    parts = [*"ab'sreltvmd\n\t1é中😀!._²", " ", "  ", "   ", "'ll", "'re", "the", "ing", "12", "\u3000", "<|endoftext|>"]
    encoder = bpe.Encoder(ranks, tokens, PATTERN)
    for n in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        encoder.clear()
        encoder.halves.clear()
        ids = encoder.encode(text)
        assert ids == theirs.encode_ordinary(text)
        assert bpe.decode_ids(tokens, ids) == text.encode()
    for text in ("a" * 3000, "ab" * 1500, " " * 3000, "\n " * 1500, "é" * 2000, "x y" * 1000):
        assert encoder.encode(text) == theirs.encode_ordinary(text)


def test_bpe_digests_and_frames(spark, theirs, awkward):
    texts = {(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()}
    want = Counter()
    for r in awkward.select("doc_id", "text").collect():
        ids = theirs.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(r.text or "")] += 1
    assert Counter(map(tuple, bpe.digests(awkward, RANKS, PATTERN).collect())) == want
    coded = bpe.decode(bpe.encode(awkward, RANKS, PATTERN), RANKS)
    assert {(r.doc_id, bytes(r.decoded).decode()) for r in coded.collect()} == {(d, t or "") for d, t in texts}


# 10 languages


def test_languages_on_held_out_rows(spark):
    rng = random.Random(8)
    alphabets = {"aa": "etaoin", "bb": "кошмар", "cc": "zqxjkv"}
    rows = []
    for k in range(300):
        lang = rng.choice(list(alphabets))
        rows.append((k, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(rng.randint(1, 30))), lang))
    rows += [(900, None, "aa"), (901, "123 !?", "bb"), (902, "etaoin", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    held = crc_mod(F.col("doc_id"), 3) == 1
    one, two = (language.fit(docs.where(~held).repartition(n)) for n in (1, 6))
    assert one.keys() == two.keys() and all(np.array_equal(one[k], two[k]) for k in one)
    found = {r.doc_id: r for r in language.predict(docs, one).collect()}
    assert all(found[k].lang_pred == lang and 0 < found[k].score <= 1 for k, _, lang in rows if k < 900)
    assert (found[900].lang_pred, found[901].lang_pred, found[902].lang_pred) == ("und", "und", "aa")


def test_bundle_is_the_sum_of_bound_permuted_letters():
    keys = language.keys_of("Ab")
    assert len(keys) == 2  # " ab" and "ab "
    letters = language.Letters()
    a, b = (int(language.letter_ranks()[ord(c)]) for c in "ab")
    v = {n: letters.of(np.array([n]), 0)[0] for n in (0, a, b)}
    want = np.roll(v[0], 2) * np.roll(v[a], 1) * v[b]
    assert np.array_equal(letters.trigrams(keys[:1])[0], want)
    assert abs(int(v[a].astype(int) @ v[b])) < 200


def test_languages_equal_plain_bundles(spark):
    """Prototypes and choices from one vector after another, without products or memos."""
    rng = random.Random(14)
    sounds = {"aa": ["ba", "lu", "mi"], "bb": ["str", "ko", "ent"], "cc": ["çà", "éo", "un"]}
    texts = [(k, " ".join("".join(rng.choices(sounds[lang], k=3)) for _ in range(rng.randint(1, 12))), lang) for k, lang in enumerate(sorted(sounds) * 12)]
    texts += [(90, None, "aa"), (91, "", "bb"), (92, "123 !", None), (93, "bamilu koent", None)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(4)
    letters = language.Letters()

    def bundle(text):
        keys = language.keys_of(text or "")
        return sum((letters.trigrams(np.array([k]))[0].astype(np.int64) for k in keys.tolist()), np.zeros(language.DIMENSIONS, np.int64)), Counter(keys.tolist())

    want = {name: sum(bundle(t)[0] for _, t, lang in texts if lang == name) for name in sounds}
    found = language.fit(df)
    assert set(found) == set(want) and all(np.array_equal(found[k], want[k]) for k in want)
    for r in language.predict(df, found).collect():
        v, counts = bundle(dict((k, t) for k, t, _ in texts)[r.doc_id])
        if not counts:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        dots = {k: float(v @ want[k]) / math.sqrt(float(want[k] @ want[k])) for k in want}
        best = max(sorted(dots), key=dots.get)
        length = math.sqrt(language.DIMENSIONS * sum(n * n for n in counts.values()))
        assert r.lang_pred == best and 0 <= r.score <= 1
        assert math.isclose(r.score, min(1, max(0, dots[best] / length)), rel_tol=1e-4, abs_tol=1e-6)


# All: awkward rows and empty tables


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    labels = spark.createDataFrame([(0, 1, 0), (3, None, None), (None, 0, 1), (3, 1, 1), (3, 0, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "one"), (None, "no id"), (2, None)], "item_id long, text string")
    pages = awkward.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html"), F.lit(1).alias("host"), F.lit(2).alias("template"))
    n = awkward.count()
    for docs, sites, marks, items, size in (
        (awkward, pages, labels, bench, n),
        (nothing, pages.where("false"), labels.where("false"), bench.where("false"), 0),
        (awkward, pages, labels.where("false"), bench.where("false"), n),
    ):
        assert toxicity.score(docs, toxicity.fit(docs, marks)).count() == size
        assert simhash.near_duplicates(docs).count() == size
        assert html_wrapper.extract(sites).count() == size
        assert decontaminate.contamination(docs, items).count() == size
        assert url_reputation.judge(sites, URL_RULES).count() == size
        assert pii.digests(docs).count() == size
        assert substring.remove(docs).count() == size
        assert quality.judge(docs, marks).count() == size
        assert language.predict(docs, language.fit(docs)).count() == size
        for out in (quality.keep_rows(docs, marks), simhash.one_per_group(docs), decontaminate.clean_rows(docs, items), pii.mask(docs)):
            assert out.columns == docs.columns and out.count() <= size


def test_rows_that_stay_are_unchanged_whatever_the_columns(spark, awkward):
    """Values, not only counts; the fixture has columns named like the operators' own."""
    def key(r):
        return hashlib.sha256(repr(tuple(r)).encode()).hexdigest()

    rows = awkward.collect()
    all_rows = Counter(map(key, rows))
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    clean = Counter(map(key, decontaminate.clean_rows(awkward, bench).collect()))
    assert clean == Counter(key(r) for r in rows if not r.text or r.text != "one")
    alone = simhash.one_per_group(awkward).collect()
    want = plain_components({k: plain_fingerprint(t) for k, t in {(r.doc_id if r.doc_id is not None else 1 << 40): r.text for r in rows}.items()})
    assert sorted(1 << 40 if r.doc_id is None else r.doc_id for r in alone) == sorted(k for k, low in want.items() if k == low)
    assert not Counter(map(key, alone)) - all_rows


def test_no_tables_no_rows_for_the_registered_url_query(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert op5_url_reputation(spark, str(tmp_path)).count() == 0
