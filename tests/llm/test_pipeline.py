"""The pipeline's stages, each against what its predecessor gave it."""

import hashlib

import corpus_pipeline
import pytest
from conftest import SF
from test_packing import check as check_packing

from tidemark.llm import ngram_join, quality, shingles, suffix_dedup
from tidemark.llm.common import table


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = [table(spark, SF, "documents")], table(spark, SF, "documents")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return [sorted(map(tuple, d.collect()), key=str) for d in out], [d.columns for d in out]


def test_columns(stages):
    _, columns = stages
    assert all(c == columns[0] for c in columns[1:5])
    assert columns[5][:2] == ["doc_id", "start"]


def test_classifier_drops_what_it_rejects(spark, stages):
    rows, _ = stages
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r[0] for r in rows[1]}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in good) >= 0.95 * len(good)
    assert sum(d in kept for d in bad) <= 0.2 * len(bad)
    assert set(rows[1]) <= set(rows[0]) and quality.SAMPLE > len(labels)


def test_exact_copies_go(stages):
    rows, _ = stages

    def plain(text):
        for space in " \t\n\x0b\x0c\r":
            text = text.replace(space, "")
        return hashlib.sha256(text.encode()).hexdigest()

    groups = {}
    for r in rows[1]:
        groups.setdefault(plain(r[1] or ""), []).append(r)
    want = [min(g, key=lambda r: (-len(r[1]), r[0])) for g in groups.values()]
    assert rows[2] == sorted(want, key=str)


def test_near_copies_go(stages):
    rows, _ = stages
    component = {d: c for d, _, c in ngram_join.brute_force([(r[0], r[1]) for r in rows[2]])}
    assert rows[3] == [r for r in rows[2] if component[r[0]] == r[0]]
    sets = [shingles.plain_set(r[1]) for r in rows[3]]
    assert not any(shingles.linked(a, b) for i, a in enumerate(sets) for b in sets[:i])


def test_repeated_strings_go(stages):
    rows, _ = stages
    ordered = sorted(rows[3])
    expected = suffix_dedup.brute_force([r[1].encode() for r in ordered])
    left = {r[0]: r for r in rows[4]}
    for r, (size, removed, _, _) in zip(ordered, expected, strict=True):
        if removed == 0:
            assert left[r[0]] == r
        elif removed < size and r[0] in left:
            text = left[r[0]][1]
            assert 0 <= size - removed - len(text.encode()) <= 6 * (removed > 0) * 10
            assert left[r[0]][4] == len(text)


def test_everything_is_packed(spark, stages):
    rows, _ = stages
    texts = [(r[0], r[1]) for r in rows[4]]
    pieces = spark.createDataFrame(rows[5], "doc_id long, start long, length long, ids_crc32 long, "
                                   "doc_tokens long, sequence_id long, offset long").collect()
    assert check_packing(texts, pieces) <= 2


def test_run_is_the_stages(spark, stages):
    rows, _ = stages
    got = corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect()
    assert sorted(map(tuple, got)) == sorted({(r[0], r[4]) for r in rows[5]})


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, None, None, None), (None, None, "en", "a", 0), (2, "", "en", "a", 0), (2, "", "en", "a", 0)],
])
def test_stages_on_odd_tables(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    assert docs.columns[:2] == ["doc_id", "start"]


def test_stages_keep_clashing_columns(spark, tmp_path):
    own = ["doc", "tie", "row", "score", "shard", "kept", "__hash", "__text", "token"]
    docs = table(spark, SF, "documents")
    docs = docs.select("*", *(docs["doc_id"].alias(c) for c in own))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert set(own) <= set(docs.columns)
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.where(" or ".join(f"doc_id <> `{c}`" for c in own)).isEmpty()
    assert docs.columns[0] == "doc_id"
