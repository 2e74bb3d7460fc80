"""The pipeline's stages on nulls, empty and long texts, repeated rows, columns
whose names clash with the operators' own, and empty tables."""

from __future__ import annotations

import re
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)
LONG = " ".join(f"word{i % 997}" for i in range(60_000))
ROWS = [
    (1, "one short text", "a"),
    (1, "one short text", "a"),
    (2, "One Short TEXT", "b"),
    (None, "one short text", None),
    (None, None, None),
    (None, "", "b"),
    (3, " \n\t ", "b"),
    (4, LONG, "a"),
    (5, LONG + " with a tail of its own", "b"),
    (6, "zoë 日本 😀 " * 30, "c"),
    (7, "x" * 200_000, "c"),
    (8, None, "c"),
]
SCHEMA = "doc_id bigint, text string, source string, row string, _id int, k binary, size int, score double, kept boolean, unit string, position bigint"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "row", 7, b"k", 3, 0.5, True, "u", None) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges"))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(1, None, 0), (None, 1, 0), (4, 1, None), (99, 0, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_quality_keeps_all_without_a_second_class(spark, docs, folder):
    out = STAGES["quality"](spark, docs, folder)
    assert out.columns == docs.columns and rows(out) == Counter(ROWS)


def test_exact_keeps_one_row_of_each_text(spark, docs, folder):
    out = STAGES["exact_dedup"](spark, docs, folder)
    assert out.columns == docs.columns
    want = {}
    for i, t, s in ROWS:
        want.setdefault(ascii_lower(t), []).append(i)
    got = {ascii_lower(r.text): r.doc_id for r in out.collect()}
    assert out.count() == len(want) and got == {t: max((i for i in ids if i is not None), default=None) for t, ids in want.items()}


def test_near_keeps_one_row_of_each_group(spark, docs, folder):
    out = STAGES["near_duplicates"](spark, docs, folder)
    assert out.columns == docs.columns
    kept = rows(out)
    # the short texts are one group, the long ones another; texts without a word stay, one row per id and text
    assert sum(n for (_, t, _), n in kept.items() if ascii_lower(t) == "one short text") == 1
    assert (4, LONG, "a") in kept and not any(i == 5 for i, *_ in kept)
    assert {(i, t or "") for i, t, _ in kept if not (t or "").split()} == {(None, ""), (3, " \n\t "), (8, "")}
    assert {6, 7} <= {i for i, *_ in kept} and max(kept.values()) == 1


def test_mix_plays_rows_up_to_three_times(spark, docs, folder):
    out = STAGES["mix"](spark, docs, folder)
    assert out.columns == docs.columns
    given, played = Counter(ROWS), rows(out)
    assert set(played) <= set(given) and all(n <= 3 * given[r] for r, n in played.items())
    words = lambda c: sum(n * len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for (_, t, _), n in c.items())
    assert words(played) <= words(given)
    assert played == rows(STAGES["mix"](spark, docs.repartition(7), folder))


def test_encode_restores_every_text(spark, docs, folder):
    out = STAGES["encode"](spark, docs, folder)
    assert out.count() == len(ROWS) and out.where("round_trip").count() == len(ROWS)


def test_run(spark, folder, tmp_path):
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and all(r.round_trip for r in out)
    ids = {r.doc_id for r in out}
    assert 5 not in ids and not ids - {r[0] for r in ROWS}
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
