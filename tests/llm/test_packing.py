import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.common import table

DOCS = "doc_id long, text string"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def crc(part):
    return zlib.crc32(np.array(part, "<u4").tobytes())


def check(docs, pieces, window=1024):
    """Pieces hold every id once, in windows without gaps."""
    want = {d: ids(t) for d, t in docs}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(want)
    for d, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[d])
            at += p.length
            assert p.ids_crc32 == crc(want[d][p.start : at])
        assert at == len(want[d])
    short = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        short += at < window
    return short


def test_whole_table(spark):
    df = table(spark, SF, "documents")
    out = packing.pack(df)
    assert [c for c in out.columns] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                        "sequence_id", "offset"]
    assert check([(r.doc_id, r.text) for r in df.collect()], out.collect()) <= 1


def test_encoder_equals_the_tokenizer():
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json").removesuffix(".json")).ids
    texts = ["a  b", "a \n b", "\n\n a", "  ", "", "a  b", "x<|endoftext|> y<|endoftext|>", " a b ",
             "\r\n x\ty  \n", "I'm  we'll\nit's 's", "日本語 テキスト 123 45", "a\x00b c\x00", "foo\n  bar",
             "é" * 10 + " " * 7 + "z", "x" * 3000 + " " * 3000 + "!" * 3000, "a\t\nb", "\x1c a\x1cb c",
             "don't  Don'T", "1 000 000,5", "<|endoftext|><|endoftext|>", "a\n b", "tab\tend\t"]
    rnd = random.Random(3)
    texts += ["".join(rnd.choice(" \n\t\x0ba1.é's<|") for _ in range(60)) for _ in range(500)]
    for text in texts:
        assert encode(text).tolist() == ids(text)[:-1], repr(text)


def test_neighbours_share_words(spark):
    """A seed's window is filled with documents of its own topic."""
    rnd = random.Random(1)
    topics = [[f"{'kxqz'[t]}{rnd.randint(1000, 9999)}" for _ in range(40)] for t in range(4)]
    rows = [(i, " ".join(rnd.choice(topics[i % 4]) for _ in range(30))) for i in range(200)]
    out = packing.pack(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    check(rows, out)
    mixed = {}
    for p in out:
        mixed.setdefault(p.sequence_id, set()).add(p.doc_id % 4)
    assert sum(len(t) == 1 for t in mixed.values()) > 0.6 * len(mixed)


@pytest.mark.parametrize("window, shard", [(64, 7), (1024, 50)])
def test_cuts_and_shards(spark, window, shard):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma", "x1"]) for _ in range(rnd.randint(0, 400))))
            for i in range(120)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    short = check(rows, packing.pack(df, window=window, shard_docs=shard).collect(), window)
    assert short <= 120 // shard + 3


def test_nulls_repeats_long_and_empty(spark):
    rows = [(1, None), (2, ""), (3, "z " * 60_000), (4, "y" * 200_000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("shard", F.lit("q")).withColumn("token", F.lit(5))
    assert check(rows, packing.pack(df).collect()) <= 4
    again = packing.pack(spark.createDataFrame([(7, "a b"), (7, "a b"), (None, "c")], DOCS)).collect()
    assert sorted((p.doc_id or 0, p.length) for p in again) == [(0, 2), (7, 3), (7, 3)]
    assert packing.pack(spark.createDataFrame([], DOCS)).collect() == []
    assert packing.pack(spark.createDataFrame([(1, None)], DOCS)).collect()[0].length == 1


def test_long_documents_are_found_by_all_their_words(spark):
    """Two documents of a topic whose rests hold none of its words meet in one window."""
    rnd = random.Random(4)
    rows = []
    for topic in range(12):
        words = [f"{'kxqz'[topic % 4]}{rnd.randint(1000, 9999)}" for _ in range(30)]
        for copy in range(2):
            head, text = " ".join(rnd.choice(words) for _ in range(150)), ""
            while len(ids(head + text)) < 1024 + 500:  # the rest is of its own
                text += f" {rnd.choice(['and', 'or', 'the', 'of', 'in', 'to', 'it', 'is'])}"
            rows.append((topic + 12 * copy, head + text))
    out = packing.pack(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    check(rows, out)
    mixed = {}
    for p in out:
        if p.length < 1024:
            mixed.setdefault(p.sequence_id, []).append(p)
    first = [min(w, key=lambda p: p.offset).doc_id % 12 for w in mixed.values()]
    second = [sorted(w, key=lambda p: p.offset)[1].doc_id % 12 for w in mixed.values() if len(w) > 1]
    assert sum(a == b for a, b in zip(first, second)) >= 10


def test_topics_spread_over_many_partitions(spark):
    """Shards hold documents of like content, wherever they were read."""
    rnd = random.Random(6)
    topics = [[f"{'kxqz'[t % 4]}{rnd.randint(1000, 9999)}" for _ in range(40)] for t in range(12)]
    # Each partition reads one document of each topic.
    rows = [(i, " ".join(rnd.choice(topics[i % 12]) for _ in range(60))) for i in range(360)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 30), DOCS)
    out = packing.pack(df, shard_docs=60).collect()
    check(rows, out)
    mixed = {}
    for p in out:
        mixed.setdefault(p.sequence_id, set()).add(p.doc_id % 12)
    assert sum(len(t) == 1 for t in mixed.values()) > 0.6 * len(mixed)
