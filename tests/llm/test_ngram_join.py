import random

import numpy as np
import pytest
from conftest import SF, SF01

from tidemark.llm import ngram_join, shingles
from tidemark.llm.common import table
from tidemark.llm.graph import components

DOCS = "doc_id long, text string"


def check(rows, df):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.digest(df).collect())
    assert got == sorted(ngram_join.brute_force(rows))
    return got


def test_words_and_shingles():
    texts = ["", " \t", "One two\x0bTHREE", "É É é a b c d", "a b c d e", "x " * 300 + "y z q", None]
    sizes = [len(s) for s in shingles.shingle_sets([(t or "").encode() for t in texts])]
    assert sizes == [len(shingles.plain_set(t)) for t in texts]
    same = [shingles.set_hash(s) for s in shingles.shingle_sets([b"One TWO", b"  one\ntwo ", b"one two two"])]
    assert same[0] == same[1] != same[2]
    long = (b"word%d " * 5 % (1, 2, 3, 4, 5)) * 200_000
    pieces = list(shingles.word_hashes([long, b"tail of it", b"q" * 5_000_000]))
    assert [len(p) for p in pieces] == [1_000_000, 3, 1]
    assert (pieces[0][:5] == pieces[0][-5:]).all()


def test_whole_table(spark):
    df = table(spark, SF, "documents")
    got = check([(r.doc_id, r.text) for r in df.collect()], df)
    assert any(d != c for d, _, c in got)


def test_larger_table(spark):
    df = table(spark, SF01, "documents")
    check([(r.doc_id, r.text) for r in df.collect()], df)


@pytest.mark.parametrize("seed", range(2))
def test_edits_around_the_threshold(spark, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60 if seed else 5000)]
    common = [rnd.choice(vocabulary) for _ in range(30)]
    rows = []
    for base in range(12):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(4, 120))]
        for _ in range(12):
            copy = list(words)
            for _ in range(rnd.randint(0, 4)):
                if copy:
                    copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            if rnd.random() < 0.4:
                copy = common + copy
            words = copy if rnd.random() < 0.3 else words
            rows.append((len(rows) * 7 - 40, " ".join(copy)))
    rnd.shuffle(rows)
    check(rows, spark.createDataFrame(rows, DOCS))


def test_exactly_eighty_percent(spark):
    # 9 shingles against 9 with 8 shared are 0.8; one word less is not.
    a = [f"a{i}" for i in range(13)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:-1] + ["z"])), (3, "b c"), (4, "B  c"), (5, "b c d")]
    got = {d: c for d, _, c in check(rows, spark.createDataFrame(rows, DOCS))}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}


def test_group_of_many_copies(spark):
    words = [f"v{i}" for i in range(40)]
    rows = [(i, " ".join(words[:35] + [f"u{i}"])) for i in range(400)]
    rows += [(1000 + i, "same text in all of these rows") for i in range(300)]
    rows += [(2000, " ".join(words[:25] + [f"q{i}" for i in range(30)]))]
    check(rows, spark.createDataFrame(rows, DOCS))


def test_nulls_repeats_and_columns(spark):
    rows = [(None, "a b c d e f", 1), (None, "a b c d e f", 1), (3, "a b c d e f", 2), (4, None, 3),
            (4, "", 4), (5, None, 5), (None, "other words here", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.digest(df).collect()), key=str)
    assert got == sorted([(None, 2, 3), (None, 2, 3), (3, 2, 3), (4, 0, 4), (4, 0, 4), (5, 0, 5),
                          (None, 1, None)], key=str)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(kept.collect(), key=str) == sorted(map(tuple, rows[2:]), key=str)
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.digest(empty).collect() == [] and ngram_join.keep_one(empty).collect() == []


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 160)]
    links += [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)] + [(7, 7), (5, 4)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    root = {n: n for pair in links for n in pair if pair[0] != pair[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_whose_places_cancel(spark):
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
        df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string") if len(a) >= 1024 else None
        if df is not None:
            assert {r.component_id for r in ngram_join.digest(df).collect()} == {1, 2}


def test_keep_one_keeps_all_columns(spark):
    rows = [(1, "a b c", "x", "y", "z", "w"), (2, "a b c", "x", "y", "z", "w"), (3, "d", "x", "y", "z", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __text string, row string, __id string, __key string")
    assert sorted(map(tuple, ngram_join.keep_one(df).collect())) == [rows[0], rows[2]]
    assert ngram_join.keep_one(df).columns == df.columns


def test_sets_differ_in_no_more_bits_than_tokens():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        pool = np.unique(rnd.integers(0, 2**63, 900).astype(np.uint64))
        a, b = pool[: rnd.integers(1, 800)], pool[rnd.integers(0, 300) :]
        differ = sum((x ^ y).bit_count() if x ^ y >= 0 else 64 - (~(x ^ y)).bit_count()
                     for x, y in zip(ngram_join._bits(a), ngram_join._bits(b)))
        assert differ <= len(np.setxor1d(a, b))


def test_only_sets_of_pairs_are_made(spark, monkeypatch):
    """Sets that meet others in a list, but are compared with none, are not made and moved."""
    rnd = random.Random(31)
    texts = []
    for _ in range(30):
        words = [str(rnd.randrange(10**9)) for _ in range(60)]
        for edits in (0, 1, 3, 9):
            changed = list(words)
            for i in rnd.sample(range(60), edits):
                changed[i] = str(rnd.randrange(10**9))
            texts.append(" ".join(changed))
    rows = list(enumerate(texts))
    made, write = [], ngram_join.pin
    monkeypatch.setattr(ngram_join, "pin", lambda df, label: made.append((label, write(df, label))) or made[-1][1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.digest(df).collect())
    assert got == ngram_join.brute_force(rows)
    pairs = [{c for r in df.collect() for c in r} for label, df in made if label == "pairs"]
    sets = [sorted(r.cls for r in df.collect()) for label, df in made if label == "sets"]
    assert sets == [sorted(p) for p in pairs] and sets[0]
    lists = next(df for label, df in made if label == "lists")
    assert len(sets[-1]) < lists.select("cls").distinct().count()


def test_texts_nobody_asks_for_are_left_out(spark, monkeypatch):
    rows = spark.range(-500, 4000).withColumnRenamed("id", "key")
    wanted = spark.range(-500, 4000, 100).withColumnRenamed("id", "key")
    kept = {r.key for r in ngram_join._maybe_in(rows, wanted, "key").collect()}
    assert kept >= set(range(-500, 4000, 100)) and len(kept) < 60
    # Few places: more is kept, never less.
    monkeypatch.setattr(ngram_join, "SIFT", 1)
    kept = {r.key for r in ngram_join._maybe_in(rows, wanted, "key").collect()}
    assert kept >= set(range(-500, 4000, 100))
    assert ngram_join._maybe_in(rows, wanted.limit(0), "key").isEmpty()
