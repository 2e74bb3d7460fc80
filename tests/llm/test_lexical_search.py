"""Ranked lexical search against a plain scan of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trafficlens.llm import k2_treap as K2
from trafficlens.llm import lexical_search as LS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    counted = [d for d in counted if d[2]]
    n_docs, total = len(counted), sum(d[2] for d in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, words in wanted.items():
        scored = []
        for d, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in words if t in c)
            scored += [(s, d)] if s > 0 else []
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(i, r, d, s) for r, (s, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Étude", "größe", "naïve", "42", "日本"]
    text = lambda m: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=m))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(n)]
    items = [(i, text(rng.randrange(1, 25)).upper()) for i in range(12)]
    return docs, items


def test_terms():
    text = "".join(map(chr, range(0x180))) + "A-b_C.d'É x y ß"
    assert [t.decode() for t in LS.terms_of(text)] == terms(text)


@pytest.mark.parametrize("shape", [(1, 1), (5, 40), (70, 9), (64, 64)])
def test_treap_holds_the_cells_and_their_maxima(shape):
    rng = np.random.default_rng(1)
    grid = rng.integers(1, 1000, shape) * (rng.random(shape) < 0.3)
    grid[0, 0] = 7
    rows, cols = np.nonzero(grid)
    order = rng.permutation(len(rows))
    treap = K2.K2Treap(rows[order], cols[order], grid[rows, cols][order], *shape)
    side, node = 1 << treap.height, {(0, 0): 0}
    for _ in range(treap.height):
        below = {}
        for (r, c), at in node.items():
            assert treap.maxima[at] == grid[r : r + side, c : c + side].max()
            for q in range(4):
                r2, c2 = r + (q >> 1) * side // 2, c + (q & 1) * side // 2
                part = grid[r2 : r2 + side // 2, c2 : c2 + side // 2]
                has, child = K2._children(treap, np.array([at]), np.array([q >> 1]), 0, q & 1)
                assert has[0] == (part.size > 0 and part.max() > 0)
                if has[0]:
                    below[(r2, c2)] = int(child[0])
        side, node = side // 2, below
    assert {k: treap.maxima[v] for k, v in node.items()} == {(r, c): grid[r, c] for r, c in zip(rows, cols)}


@pytest.mark.parametrize("fine, width", [(0, 1), (2, 4), (5, 64), (30, 64)])
def test_search_is_exact_and_halts_early(monkeypatch, fine, width):
    monkeypatch.setattr(K2, "FINE", fine)
    monkeypatch.setattr(K2, "WIDTH", width)
    rng = np.random.default_rng(2)
    taken = 0
    for _ in range(30):
        grid = rng.integers(1, 50, (40, 500)) * (rng.random((40, 500)) < rng.choice([0.02, 0.3]))
        rows, cols = np.nonzero(grid)
        treap = K2.K2Treap(rows, cols, grid[rows, cols], *grid.shape)
        ids = rng.permutation(500)
        own, weight = rng.choice(40, 6, replace=False), rng.integers(1, 9, 6)
        best = K2.Best(5)
        taken += K2.search(treap, own, weight, ids, K2.range_minima(ids, treap.height), best)
        score = (grid[own] * weight[:, None]).sum(axis=0)
        want = sorted(((-int(s), int(i)) for s, i in zip(score, ids) if s > 0))[:5]
        assert best.ranked() == [(-s, i) for s, i in want]
    if fine < 9:
        assert taken < 30 * 999  # fewer ranges than a tree over 500 columns has


def test_ties_go_to_the_smaller_id():
    ids = np.arange(100)[::-1].copy()
    treap = K2.K2Treap(np.zeros(100, int), np.arange(100), np.full(100, 9), 1, 100)
    best = K2.Best(3)
    K2.search(treap, np.array([0]), np.array([2]), ids, K2.range_minima(ids, treap.height), best)
    assert best.ranked() == [(18, 0), (18, 1), (18, 2)]


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = corpus(1)
    same = docs[5][1]
    docs += [(1000 + i, same) for i in range(60)] + [(None, same), (7, same), (7, same), (2000, None), (2001, ""), (2002, " .,; "), (2003, "only here " * 20_000)]
    items += [(50, same), (50, "HERE"), (None, "größe 42"), (51, None), (52, ""), (53, "unknownword"), (54, same), (50, same)]
    make = lambda rows, c: spark.createDataFrame([(*r, 1, "t", 2) for r in rows], f"{c} bigint, text string, rank int, term string, score bigint").repartition(4)
    return docs, items, make(docs, "doc_id"), make(items, "item_id")


@pytest.mark.parametrize("cells, block", [(2 << 20, 2_000_000), (300, 40)])
def test_operator(tables, cells, block):
    docs, items, d, i = tables
    got = LS.rank_documents(d, i, block_terms=block, cells=cells)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items)


def test_statistics(tables):
    docs, _, d, _ = tables
    counted = [Counter(terms(t)) for _, t in docs]
    want = Counter(t for c in counted for t in c)
    stats = {r.term and bytes(r.term).decode(): r.df for r in LS.corpus_statistics(d).collect()}
    assert stats.pop(None) == sum(bool(c) for c in counted) and stats == want


def test_empty_tables(tables):
    _, _, d, i = tables
    assert LS.rank_documents(d.limit(0), i).count() == 0
    assert LS.rank_documents(d, i.limit(0)).count() == 0
    assert LS.rank_documents(d.where("doc_id in (2000, 2001)"), i).count() == 0
