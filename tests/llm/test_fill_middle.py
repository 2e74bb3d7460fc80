"""Fill-in-the-middle against units made by a regular expression."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from trafficlens.llm import fill_middle as FM

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LETTERS = list("ab \n\té€😀\x0b\x0e\x08\x1f!~\x85   ")


def brute(i, text, seed=42, rate=50, spm=80):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return i, n, "plain", None, None, text, text
    if h4 % 100 < spm:
        return i, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return i, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_words_and_marks():
    raw = np.frombuffer(bytes(range(256)), np.uint8)
    bits = np.unpackbits(FM.white_space(raw.view(np.uint64)).view(np.uint8)).reshape(-1, 8)[:, 0]
    assert {int(i) for i in np.flatnonzero(bits)} == {0x20, *range(0x09, 0x0E)}
    for word in (0x80, 0x8080808080808080, 0x8000000000000000, 0x0080800080000080):
        at = [i for i in range(8) if word >> (8 * i + 7) & 1]
        k = np.arange(1, len(at) + 1)
        assert FM.select_in_word(np.full(len(at), word, np.uint64), k).tolist() == at


@pytest.mark.parametrize("most", [1, 64, 4 << 20])
def test_cuts(monkeypatch, most):
    monkeypatch.setattr(FM, "SLICE", most)
    monkeypatch.setattr(FM.slices, "__defaults__", (most,))
    texts = random_texts(3000)
    rng = random.Random(5)
    h = [[rng.randrange(2**32) for _ in texts] for _ in range(2)]
    whole = pa.array(["dropped", *texts])[1:]  # an array that starts inside its buffers
    got = FM.cut_texts(whole, pa.array(h[0]), pa.array(h[1])).to_pylist()
    for text, x, y, row in zip(texts, *h, got):
        units = UNIT.findall(text)
        a, b = sorted((x % (len(units) + 1), y % (len(units) + 1)))
        assert row == {"n": len(units), "prefix_chars": len("".join(units[:a])), "middle_chars": len("".join(units[a:b]))}


def test_operator(spark):
    texts = [None, "", " ", "a", "\n\n", "has <M> inside", "< P>", "<<S", *random_texts(400), "long word " * 300_000, "x" * 1_000_000, " " * 1_000_000]
    rows = [*enumerate(texts), (None, "no id here"), (7, "same id"), (8, "same row"), (8, "same row")]
    clash = [(i, t, "n", "form", "output", 1) for i, t in rows]
    df = spark.createDataFrame(clash, "doc_id bigint, text string, n string, form string, output string, _cut int").repartition(4)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    out = FM.fill_in_middle(df)
    assert out.columns == columns
    assert sorted(map(repr, (tuple(r) for r in out.collect()))) == sorted(repr(brute(i, t)) for i, t in rows)
    always = FM.fill_in_middle(df, seed=1, rate=100, spm_rate=0, sentinels=("[p]", "[s]", "[m]")).collect()
    assert {r.form for r in always} == {"plain", "psm"}
    assert all(r.restored == (t or "") for r in always for i, t in rows if i == r.doc_id and i not in (7, 8))
    assert FM.fill_in_middle(df.limit(0)).count() == 0


def test_plan_has_no_shuffle(spark):
    plan = FM.fill_in_middle(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
