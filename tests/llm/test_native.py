"""Chat formatting, exact dedup and sharding against SQL, and their edge cases."""

import hashlib

import pytest
from conftest import SF
from llm_sql import agrees
from pyspark.sql import functions as F

from tidemark.llm import chat, exact_dedup, sharding
from tidemark.llm.common import table

CHAT = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


def test_chat_whole_table(spark):
    agrees(chat.digest(table(spark, SF, "conversations")), chat.ORACLE)


NASTY = ["<|im_end|>", "\\", "\\b", "<\\|", "<|", "<||", "\\\\<|\\", "a\nb", "\\n", "", None, "<\\b|", "é<|im_start|>\n"]


def test_chat_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "a\nb\\n<|"][i % 3], t) for i, t in enumerate(NASTY)]
    back = chat.read_back(chat.examples(spark.createDataFrame(rows, CHAT))).first()
    assert [(t.role, t.text) for t in back.turns] == [(r, t or "") for _, _, r, t in rows]
    assert back.loss == [t or "" for _, _, r, t in rows if r == "assistant"]


def test_chat_each_reply_is_an_example(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "r<|"), (1, 2, "assistant", ""), (1, 3, "user", "z")]
    out = chat.examples(spark.createDataFrame(rows, CHAT)).orderBy("example").collect()
    q = "<|im_start|>user\nq<|im_end|>\n"
    assert out[0].text == q + "<|im_start|>assistant\nr<\\|<|im_end|>\n"
    assert out[0].text[out[0].loss_start:][: out[0].loss_chars] == "r<\\|"
    assert [r.loss_chars for r in out] == [4, 0, 0]
    assert out[2].text.endswith("<|im_start|>user\nz<|im_end|>\n")


def test_chat_nulls_ties_and_empty(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (2, 1, "user", "b"),
            (2, 1, "user", "a"), (2, 1, "user", "a"), (3, 0, "assistant", "é" * 200_000)]
    df = spark.createDataFrame(rows, CHAT).withColumn("turns", F.lit(1)).withColumn("example", F.lit(2))
    got = {r.conv_id: r for r in chat.read_back(chat.examples(df)).collect()}
    assert [(t.role, t.text) for t in got[None].turns] == [("", ""), ("assistant", "x")]
    assert [t.text for t in got[2].turns] == ["a", "a", "b"] and got[2].loss == []
    assert got[3].loss == ["é" * 200_000]
    assert chat.examples(spark.createDataFrame([], CHAT)).collect() == []
    only = chat.digest(spark.createDataFrame([], CHAT)).collect()
    assert [r.conv_id for r in only] == [-1] and only[0].n_turns == 2


def test_exact_whole_table(spark):
    got = agrees(exact_dedup.decisions(table(spark, SF, "documents")), exact_dedup.ORACLE)
    assert len(got) == 200


EXACT = [(5, "a b"), (4, "ab"), (3, "a  b"), (2, "a\tb\n"), (9, None), (8, ""), (7, " \x0b\x0c\r"),
         (10, "A b"), (11, "x" * 300_000), (12, "x" * 299_999 + " x"), (13, "a b")]


def test_exact_rules(spark):
    df = spark.createDataFrame(EXACT, DOCS)
    agrees(exact_dedup.decisions(df), exact_dedup.ORACLE, {"documents": df.toArrow()})
    got = {r.doc_id: r for r in exact_dedup.decisions(df).collect()}
    assert [got[i].keep_id for i in (2, 3, 4, 5)] == [2, 2, 2, 2]
    assert got[9].keep_id == got[8].keep_id == 7 and got[7].group_size == 3
    assert got[11].keep_id == 12 and got[13].kept
    assert got[9].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_exact_keeps_one_whole_row(spark):
    rows = [(1, "a b", "p"), (1, "a b", "p"), (2, "a b", "q"), (None, "a  b", "r"), (3, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = exact_dedup.keep_one(df)
    assert out.columns == df.columns
    assert sorted(out.collect(), key=str) == sorted([(None, "a  b", "r"), (3, None, "s")], key=str)
    decided = exact_dedup.decisions(df).collect()
    assert len(decided) == 5 and [r.doc_id for r in decided if r.kept] in ([None, 3], [3, None])


def test_exact_empty(spark):
    df = spark.createDataFrame([], DOCS)
    assert exact_dedup.decisions(df).collect() == [] and exact_dedup.keep_one(df).collect() == []


def test_sharding_whole_table(spark):
    agrees(sharding.shards(table(spark, SF, "documents")), sharding.ORACLE)


def expected_depths(rows, limit):
    """Split buckets one bit at a time, as the directory does."""
    out = {}

    def split(bucket, depth):
        if sum(b for _, b in bucket) <= limit or len({h for h, _ in bucket}) == 1:
            out.update({h: depth for h, _ in bucket})
            return
        for bit in (0, 1):
            part = [(h, b) for h, b in bucket if h >> (sharding.HASH_BITS - 1 - depth) & 1 == bit]
            if part:
                split(part, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [1, 700, 20_000, 100_000])
def test_sharding_splits_only_what_is_too_large(spark, limit):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(150)] + [(1000, "y" * 50_000), (None, "z"), (7, None)]
    df = spark.createDataFrame(rows, DOCS)
    hashed = df.select("doc_id", "text", sharding.document_hash().alias("h")).collect()
    want = expected_depths([(r.h, len(r.text or "")) for r in hashed], limit)
    out = sharding.shards(df, limit).collect()
    assert len(out) == len(rows)
    depth = {(r.doc_id, len(r.text or "")): (want[r.h], format(r.h, "060b")) for r in hashed}
    total = {}
    for r in out:
        d, bits = depth[(r.doc_id, r.n_bytes)]
        assert r.depth == d and r.shard == bits[:d] and r.overflow == 0
        total.setdefault(r.shard, []).append(r.n_bytes)
    assert all(sum(t) <= limit or len([b for b in t if b]) == 1 for t in total.values())


def test_sharding_copies_overflow(spark, tmp_path):
    rows = [(1, "abc")] * 25_000 + [(2, "q")]
    df = spark.createDataFrame(rows, DOCS).withColumn("hash", F.lit(1)).withColumn("shard", F.lit(2))
    out = sharding.shards(df, 30).groupBy("doc_id", "shard", "overflow").agg(
        F.sum("n_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in out) == 25_001 and all(r.b <= 30 for r in out)
    sharding.write_shards(df, str(tmp_path / "out"), 30)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 25_001
    assert sharding.shards(spark.createDataFrame([], DOCS)).collect() == []


def test_keep_one_keeps_all_columns(spark):
    rows = [(1, "a b", "x", "y", "z", "w"), (2, "ab", "x", "y", "z", "w"), (3, "c", "x", "y", "z", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __hash string, row string, __norm string, __rank string")
    assert sorted(map(tuple, exact_dedup.keep_one(df).collect())) == [rows[0], rows[2]]
