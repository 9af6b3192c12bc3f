import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF

from tidemark.llm import resampling
from tidemark.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


def brute(docs, target, words=1, buckets=10_000, least=20, percent=10):
    def of(text):
        found = WORD.findall((text or "").translate(LOWER))
        runs = [" ".join(found[i : i + n]) for n in range(1, words + 1) for i in range(len(found) - n + 1)]
        return len(found), [zlib.crc32(r.encode()) % buckets for r in runs]

    own = [(d, *of(t)) for d, t in docs]
    s, t = Counter(b for *_, f in own for b in f), Counter(b for x in target for b in of(x)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for d, n, found in own:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(found), weight, weight + noise, None, n])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(fit[: len(fit) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def rows_of(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 5
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs, target = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert rows_of(resampling.resample(docs, target)) == want
    assert any(r[4] for r in want)


@pytest.mark.parametrize("words", [1, 2, 3])
def test_odd_texts(spark, words):
    rnd = random.Random(words)
    vocabulary = ["A", "zÉ", "Éa", "İi", "x1", "it's", "日本", "q" * 63, "Q" * 64, "w" * 65, "v" * 200, " ", "a\x00b"]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(60)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .,"), (None, "a b " * 20), (203, docs[3][1]), (203, docs[3][1]),
             (204, "x" * 5000 + " " + "y" * 300)]
    target = ["A b a", None, "", "zÉ x1 x1"]
    df = spark.createDataFrame([(*d, "en") for d in docs], DOCS + ", score string")
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, item_id long")
    got = rows_of(resampling.resample(df, goal, words=words))
    assert got == brute(docs, target, words)


def test_huge_texts(spark, monkeypatch):
    monkeypatch.setattr(resampling, "CHUNK", 300)
    docs = [(1, "ab cd " * 500), (2, "x" * 1000 + " y"), (3, "é" * 500 + "." + "k " * 400), (4, "short one")]
    df = spark.createDataFrame(docs, DOCS)
    goal = spark.createDataFrame([("ab k",)], "text string")
    assert rows_of(resampling.resample(df, goal)) == brute(docs, ["ab k"])


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "a " * 30)], DOCS)
    assert rows_of(resampling.resample(none, none)) == []
    assert rows_of(resampling.resample(some, none)) == brute([(1, "a " * 30)], [])


def test_checksums_of_any_length():
    rnd = np.random.default_rng(1)
    sizes = [*range(1, 300), 1000, 4097, 64 * 64]
    buf = rnd.integers(0, 256, sum(sizes), np.uint8)
    end = np.cumsum(sizes)
    start = end - sizes
    want = [zlib.crc32(buf[a:b].tobytes()) for a, b in zip(start, end, strict=True)]
    assert resampling.checksums(buf, start, end).tolist() == want
