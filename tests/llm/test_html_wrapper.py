"""Alignment of page trees and templates, against plain versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from histlake.llm import html_wrapper as hw


def layout(tree) -> str:
    label, kids = tree
    return " ".join([f"{label} {len(kids)}", *map(layout, kids)])


def random_tree(r: random.Random, depth: int = 0):
    many = r.choice([0, 0, 1, 2, 3, 4]) if depth < 4 else 0
    return r.choice("abc"), tuple(random_tree(r, depth + 1) for _ in range(many if depth else 4))


@lru_cache(maxsize=None)
def plain_score(a, b) -> int:
    """Simple tree matching as it is defined, cell by cell."""
    if a[0] != b[0]:
        return 0
    best = defaultdict(int)
    for x, kid in enumerate(a[1], 1):
        for y, other in enumerate(b[1], 1):
            best[x, y] = max(best[x - 1, y], best[x, y - 1], best[x - 1, y - 1] + plain_score(kid, other))
    return 1 + best[len(a[1]), len(b[1])]


@pytest.mark.parametrize("cells", [1 << 20, 4])
def test_matching_is_as_large_as_the_plain_one_and_keeps_order(monkeypatch, cells):
    monkeypatch.setattr(hw, "CELLS", cells)
    r = random.Random(5)
    for _ in range(150):
        one, other = random_tree(r), random_tree(r)
        kinds: dict = {}
        a, b = hw.Tree(layout(one), kinds), hw.Tree(layout(other), kinds)
        found = hw.Matching(a, b).partners()
        pairs = [(x, y) for x, y in enumerate(found) if y >= 0]
        assert len(pairs) == plain_score(one, other)
        assert len({y for _, y in pairs}) == len(pairs)
        assert all(a.labels[x] == b.labels[y] for x, y in pairs)
        assert all(y == 0 if x == 0 else found[a.parents[x]] == b.parents[y] for x, y in pairs)
        assert [y for _, y in pairs] == sorted(y for _, y in pairs)


def test_halving_finds_the_same_weight():
    r = np.random.default_rng(3)
    for _ in range(50):
        weights = r.integers(0, 4, (r.integers(1, 9), r.integers(1, 9)))
        whole = hw.matched(weights)
        assert sum(weights[x, y] for x, y in whole) == hw.last_row(weights)[-1]


def sites(n: int, r: random.Random) -> list[tuple[int, str, str]]:
    """Pages of two hosts whose notes stand between blocks that only some pages have."""
    out = []
    for k in range(n):
        host = r.choice("gh")
        parts = [f"<section><h2>Part {j}</h2><p>Words {k} {j}</p></section>" for j in range(r.choice([1, 1, 1, 2, 3]))]
        if r.random() < 0.4:
            parts.insert(0, f"<div><p>Extra {k}</p></div>")
        parts.insert(r.choice([0, len(parts)]) if r.random() < 0.2 else len(parts), f"<div><p>Printed on {host}</p></div>")
        out.append((k, f"http://{host}.org/{k}", f"<article><h1>Title {k}</h1>{''.join(parts)}</article>"))
    return out


def plain_extract(pages) -> dict[int, str]:
    """Slots of all pages of a host counted in dictionaries."""
    by_host = defaultdict(list)
    for k, url, html in pages:
        root = hw.parse(html)
        region, found = hw.article(root)
        text, leaves, nodes = hw.layout_of(hw.shape_of(root, found))
        by_host[url.split("/")[2]].append((k, region, text, leaves, nodes))
    out = {}
    for rows in by_host.values():
        seen = Counter(r[2] for r in rows)
        centre = max(seen, key=lambda t: (seen[t], np.uint64(hw.digest(t)).view(np.int64)))
        slots = {t: hw.slots_of(t, centre) for t in seen}
        carried, used = Counter(), Counter()
        own = {}
        for k, _, text, leaves, nodes in rows:
            half = len(slots[text]) // 2
            own[k] = [{(slots[text][n], leaf.text), (slots[text][half + n], leaf.text)} for n, leaf in zip(nodes, leaves)]
            carried.update(set().union(*own[k]))
            used.update({s for x in own[k] for s, _ in x})
        for k, region, _, leaves, _ in rows:
            constant = [any(used[s] >= 8 and carried[s, t] >= 0.95 * used[s] for s, t in x) for x in own[k]]
            out[k] = "\n\n".join(hw.blocks([n.text for n in leaves], constant, [n.holder in hw.HEADINGS for n in leaves], region > 0))
    return out


def extracted(spark, pages, parts=3):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)
    return {r.page_id: r.text for r in hw.extract(df).collect()}


def test_texts_equal_a_plain_count_over_aligned_slots(spark):
    pages = sites(120, random.Random(8))
    want = plain_extract(pages)
    assert extracted(spark, pages) == want
    kept = sum("Printed on" in t for t in want.values())
    assert kept < 40 and all(f"Title {k}" in t and f"Words {k} 0" in t for k, t in want.items())


def test_a_note_is_found_behind_blocks_that_come_and_go(spark):
    """Its place among its siblings and its label path vary; its partner in the centre doesn't."""
    pages = []
    for k in range(40):
        more = "".join(f"<div><h3>Box {k} {j}</h3><p>Text {k} {j}</p></div>" for j in range(k % 3))
        pages.append((k, "http://h.org/", f"<article><p>Start {k} of a longer text</p>{more}<div><p>Terms apply</p></div></article>"))
    found = extracted(spark, pages)
    assert all("Terms apply" not in t and f"Start {k}" in t for k, t in found.items())


def test_deep_long_and_empty_pages(spark):
    deep = "<div>" * 3000 + "<p>deep" + "</div>" * 3000
    long = "".join(f"<h2>Part {j}</h2><p>Words {j}</p><ul><li>{j}</li></ul>" for j in range(3000))
    pages = [(k, "http://h.org/", x) for k, x in enumerate([deep, long, long.replace("h2", "h3", 1), "", "<p>x", deep.replace("deep", "other")] * 2)]
    found = extracted(spark, pages)
    assert found[0] == "deep" and found[5] == "other" and found[3] == "" and found[4] == "x"
    assert found[1] == "\n\n".join(f"Part {j}\n\nWords {j}\n\n{j}" for j in range(3000)) == found[2]
