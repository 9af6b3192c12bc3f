import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm import suffix_dedup
from tidemark.llm.common import table

SCHEMA = "doc_id long, text string"


def check(rows):
    got = {r.doc_id: r for r in rows[1]}
    texts = [(t or "").encode() for _, t in rows[0]]
    for (i, _), want in zip(rows[0], suffix_dedup.brute_force(texts), strict=True):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, i


def run(spark, rows):
    return rows, suffix_dedup.digest(spark.createDataFrame(rows, SCHEMA)).collect()


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    check((rows, suffix_dedup.digest(docs).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_pieces_in_other_surroundings(spark, seed):
    rnd = random.Random(seed)
    letters = "ab" if seed == 0 else "abcdefgh é"
    pool = ["".join(rnd.choice(letters) for _ in range(rnd.randint(60, 260))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rnd.choice(pool) if rnd.random() < 0.6 else
                 "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200)))
                 for _ in range(rnd.randint(0, 5))]
        text = "".join(p[rnd.randint(0, 30):] for p in parts)
        rows.append((i * 3 - 20, text))
    rows += [(1000, "x" * 500), (1001, None), (1002, ""), (1003, "x" * 99), (1004, "x" * 100)]
    check(run(spark, sorted(rows)))


def test_long_text_and_copies(spark):
    rnd = random.Random(7)
    long = "".join(rnd.choice("abcdefghijklm nop") for _ in range(1_500_000))
    rows = [(0, long), (1, long[5000:9000]), (2, long), (3, "z" + long[-150:] + "q")]
    rows += [(10 + i, long[:300]) for i in range(40)]
    _, got = run(spark, rows)
    by = {r.doc_id: r for r in got}
    assert by[0].n_removed == 0 and by[2].n_removed == len(long)
    assert by[1].n_removed == 4000 and by[3].n_removed == 150 and by[3].n_bytes == 152
    assert all(by[10 + i].n_removed == 300 for i in range(40))


def test_ids_null_and_repeated(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(None, text), (5, text), (5, text), (5, text + "!"), (None, "w")]
    got = run(spark, rows)[1]
    assert len(got) == 5
    five = [r for r in got if r.doc_id == 5]
    same = [r for r in five if r.n_bytes == len(text)]
    assert same[0] == same[1]
    none = {r.n_bytes: r for r in got if r.doc_id is None}
    assert none[len(text)].n_removed == len(text) and none[1].n_removed == 0


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, [])[1] == []
    df = spark.createDataFrame([(1, "a", "v", 3)], "doc_id long, text string, kept string, doc long")
    out = suffix_dedup.remove_repeats(df.withColumn("spans", F.lit(1)))
    assert [r.n_bytes for r in out.collect()] == [1]


def test_equal_rows_keep_their_text(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(5, text), (5, text), (5, text + "!"), (9, text), (None, "y" * 50 + text[::-1]), (None, "y" * 50 + text[::-1])]
    for parts in (1, 6):
        got = suffix_dedup.digest(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
        # One of the two texts of 5 comes first, by a hash; what is equal to it in id and text loses nothing.
        gone = sorted((r.n_bytes - len(text), r.n_removed) for r in got if r.doc_id == 5)
        assert gone in ([(0, 0), (0, 0), (1, len(text))], [(0, len(text)), (0, len(text)), (1, 0)])
        assert [r.n_removed for r in got if r.doc_id == 9] == [len(text)]
        assert [r.n_removed for r in got if r.doc_id is None] == [0, 0]


def mirrored(steps):
    """Two texts of two letters whose places cancel in sums over powers."""
    a, b = "a", "b"
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


def test_two_letters(spark):
    a, b = mirrored(10)
    check(run(spark, [(1, a[:300]), (2, b[:300]), (3, "x" + a[64:500]), (4, b[100:800] + a[3:160])]))


def test_cut_texts_keeps_all_columns(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    names = ["doc", "tie", "text", "row", "__doc", "__blobs", "left", "again", "doc_id", "score"]
    rows = [(*[f"{c}{i}" if c != "text" else text + "tail" * i for c in names[:8]], i, None) for i in (1, 2)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names[:8]) + ", doc_id long, score double")
    out = {r.doc_id: r for r in suffix_dedup.cut_texts(df).collect()}
    assert suffix_dedup.cut_texts(df).columns == names
    assert tuple(out[1]) == rows[0] and out[2].doc == "doc2" and out[2].left == "left2" and len(out[2].text) < 10
    kept = suffix_dedup.remove_repeats(df)
    assert kept.columns == [c for c in names if c != "text"] + ["n_bytes", "n_removed", "n_spans", "kept"]
