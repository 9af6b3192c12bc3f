import random
import re

import numpy as np
import pytest
from conftest import SF, SF01
from pyspark.sql import functions as F

from tidemark.llm import paragraph_dedup
from tidemark.llm.common import table
from tidemark.llm.shingles import plain_set

DOCS = "doc_id long, text string"


def check(rows, df):
    got = {r.doc_id: r for r in paragraph_dedup.report(df).collect()}
    want = paragraph_dedup.brute_force(rows)
    assert {d: (r.removed, r.removed_short) for d, r in got.items()} == want
    for d, text in rows:
        r = got[d]
        assert r.n_paragraphs == len(paragraph_dedup.plain_paragraphs(text))
        assert r.n_removed == len(r.removed) == len(r.kept_in) and r.n_short == len(r.removed_short)
    return got


def test_whole_tables(spark):
    for sf in (SF, SF01):
        df = table(spark, sf, "documents")
        # Only paragraphs short enough for the plain definition: the others are cut by content.
        rows = [(r.doc_id, r.text) for r in df.collect()]
        long = {d for d, t in rows for p in paragraph_dedup.plain_paragraphs(t) if len(p.split()) > paragraph_dedup.LONG}
        rows = [r for r in rows if r[0] not in long]
        assert len(rows) > 100
        got = check(rows, df.where(~F.col("doc_id").isin(list(long))))
        assert sum(r.n_removed for r in got.values()) > 10


def test_bands_are_tuned():
    bands, rows = paragraph_dedup.BANDS, paragraph_dedup.ROWS
    assert 1 - (1 - 0.8**rows) ** bands >= paragraph_dedup.RECALL
    rnd = np.random.default_rng(0)
    pool = np.unique(rnd.integers(0, 2**63, 200_000).astype(np.uint64))
    rnd.shuffle(pool)
    missed = 0
    for i in range(1000):
        part = pool[i * 100 : (i + 1) * 100]
        both = np.concatenate([np.sort(part[:90]), np.sort(part[10:])])
        sa, sb = paragraph_dedup.signature(both, np.array([0, 90]))
        missed += not (sa == sb).any()
    assert missed <= 3  # at similarity 0.8


@pytest.mark.parametrize("chunk", [1 << 18, 200])
def test_paragraphs_are_those_of_the_definition(monkeypatch, chunk):
    monkeypatch.setattr(paragraph_dedup, "_CHUNK", chunk)
    rnd = random.Random(chunk)
    marks = [" ", " ", " ", " ", "\n", ". ", "! ", "?\t", ".", " . ", "\n\n", ".\n", "  ", "\x0b", " é. "]
    texts = ["".join(rnd.choice(["a", "Bc", "ß", "d1"]) + rnd.choice(marks) for _ in range(rnd.randrange(80))) for _ in range(60)]
    raw = [t.encode() for t in texts]
    found = {}
    for p in paragraph_dedup.paragraphs(raw):
        for i in range(len(p.text)):
            found.setdefault(int(p.text[i]), []).append((int(p.number[i]), int(p.begin[i]), int(p.words[i]), int(p.size[i])))
    for t, text in enumerate(texts):
        parts = paragraph_dedup.plain_paragraphs(text)
        got = found.get(t, [])
        assert [g[0] for g in got] == list(range(len(parts)))
        for (_, begin, words, size), part in zip(got, parts, strict=True):
            part = part.strip(" \t\n\x0b\x0c\r")
            assert raw[t][begin:].startswith(part.encode()) and size == len(plain_set(part))
            assert words == len(re.split("[ \t\n\x0b\x0c\r]+", part))


def test_long_paragraphs_are_cut_alike_everywhere():
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    one = next(paragraph_dedup.paragraphs([" ".join(words).encode()]))
    two = next(paragraph_dedup.paragraphs([("x y z " + " ".join(words[30:])).encode()]))
    assert len(one.cls) > 8
    assert len(set(one.cls.tolist()) & set(two.cls.tolist())) >= len(two.cls) - 2


def test_passages_inside_other_text(spark):
    """A passage of some sentences is found wherever it stands, and only it."""
    rnd = random.Random(11)

    def sentence(n):
        return " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(10**6)}" for _ in range(n)) + rnd.choice(".!?")

    passage = " ".join(sentence(rnd.randint(4, 14)) for _ in range(8))
    rows, planted = [], set()
    for i in range(120):
        before, after = (" ".join(sentence(rnd.randint(3, 12)) for _ in range(6)) for _ in "ab")
        if i % 3 == 0:
            cut = before.rsplit(" ", rnd.randint(1, 4))[0]
            rows.append((i, f"{cut} {passage} {after}"))
            planted.add(i)
        else:
            rows.append((i, f"{before}\nA common line.\n{after}"))
    got = check(rows, spark.createDataFrame(rows, DOCS))
    assert {d for d, r in got.items() if r.n_removed} == planted - {0}
    # The common line is no passage, but it is not lost.
    assert sum(r.n_short for r in got.values()) == 79


def test_edited_paragraphs(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(15, 60))] for _ in range(8)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(1, 4)):
            line = list(rnd.choice(base)) if rnd.random() < 0.6 else [rnd.choice(words) for _ in range(30)]
            for _ in range(rnd.randint(0, 2)):
                line[rnd.randrange(len(line))] = rnd.choice(words)
            lines.append(" ".join(line))
        rows.append((i * 5, "\n".join(lines)))
    # Pairs at the very threshold may collide in no band.
    sets = [plain_set(line) for _, t in rows for line in t.split("\n")]
    close = [1 for i, a in enumerate(sets) for b in sets[:i] if a | b and 0.8 <= len(a & b) / len(a | b) < 0.82]
    got = paragraph_dedup.report(spark.createDataFrame(rows, DOCS)).collect()
    want = paragraph_dedup.brute_force(rows)
    wrong = sum((r.removed, r.removed_short) != want[r.doc_id] for r in got)
    assert wrong <= len(close) // 100


def test_texts_without_their_repeats(spark):
    line = " ".join(f"a{i}" for i in range(40))
    near = " ".join([f"a{i}" for i in range(39)] + ["b"])
    rows = [(1, f"head\n{line}\ntail", 1), (2, f"{near}\nown words", 2), (3, line.upper(), 3), (4, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tie int")
    out = paragraph_dedup.remove(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: rows[0][1], 2: "own words", 3: "", 4: None}
    more = spark.createDataFrame([(1, "Same words. Own."), (2, "  Other.  same words. End"), (3, "a")], DOCS)
    assert {r.doc_id: r.text for r in paragraph_dedup.remove(more).collect()}[2] == "  Other.  same words. End"
    assert {r.doc_id: r.text for r in paragraph_dedup.remove(more, short=True).collect()}[2] == "  Other.  End"
    got = {r.doc_id: (r.removed, r.kept_in) for r in paragraph_dedup.report(df).collect()}
    assert got == {1: ([], []), 2: ([0], [1]), 3: ([0], [1]), 4: ([], [])}


def test_nulls_repeats_long_and_empty(spark):
    line = " ".join(f"c{i}" for i in range(30))
    long = " ".join(f"d{i}" for i in range(150_000))
    pieces = sum(len(p.text) for p in paragraph_dedup.paragraphs([long.encode()]))
    assert pieces > 5000
    rows = [(None, line), (None, line), (5, line), (5, line), (5, "x\n" + line), (6, ""), (7, long), (8, long)]
    df = spark.createDataFrame(rows, DOCS).withColumn("para", F.lit(1)).withColumn("cls", F.lit("q"))
    got = sorted(((r.doc_id, r.n_paragraphs, r.removed) for r in paragraph_dedup.report(df).collect()), key=str)
    assert len(got) == 6
    assert sum(len(r[2]) for r in got) == 2 + pieces and (None, 1, [0]) in got and (6, 0, []) in got
    assert [r[2] for r in got if r[0] == 8] == [list(range(pieces))]
    assert paragraph_dedup.report(spark.createDataFrame([], DOCS)).collect() == []


def test_a_line_in_every_document(spark):
    rnd = random.Random(9)
    line = " ".join(f"e{i}" for i in range(60))
    rows = [(i, line + "\n" + " ".join(f"f{rnd.random()}" for _ in range(25))) for i in range(500)]
    got = check(rows, spark.createDataFrame(rows, DOCS))
    assert sum(r.n_removed for r in got.values()) == 499


def test_short_lines(spark):
    """Lines of one word or more repeat too; lines without words never do."""
    near = "a line of some words that is long enough for one edit at its very end"
    rows = [(1, "Same licence line\n\nown one\nx"), (2, "same LICENCE  line\n \nown two\nx\nx"),
            (3, near), (4, near + " now"), (5, "one two three four five"), (6, "one two three four six")]
    got = check(rows, spark.createDataFrame(rows, DOCS))
    assert [(d, got[d].removed_short) for d in sorted(got)] == [(1, []), (2, [0, 2, 3]), (3, []), (4, [0]), (5, []), (6, [])]
    assert not any(r.removed or r.kept_in for r in got.values())


def test_words_whose_places_cancel(spark):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    check([(1, a), (2, b)], spark.createDataFrame([(1, a), (2, b)], DOCS))


def test_remove_keeps_all_columns(spark):
    line = " ".join(f"n{i}" for i in range(25))
    rows = [(i, f"{line}\n{i}", "x", "y", "z") for i in (1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string, __doc string, gone string")
    out = {r.doc_id: r for r in paragraph_dedup.remove(df).collect()}
    assert tuple(out[1]) == rows[0] and tuple(out[2]) == (2, "2", "x", "y", "z")


def test_sets_differ_in_no_more_bits_than_tokens():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        pool = np.unique(rnd.integers(0, 2**63, 60).astype(np.uint64))
        a, b = pool[: rnd.integers(1, 50)], pool[rnd.integers(0, 30) :]
        x, y = paragraph_dedup.parities(np.concatenate([a, b]), np.array([0, len(a)])).view(np.uint64).tolist()
        assert (x ^ y).bit_count() <= len(np.setxor1d(a, b))
