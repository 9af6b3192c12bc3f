import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm import pieces
from tidemark.llm.common import table

DOCS = "doc_id long, text string"
PATH = public_tokenizers.path(pieces.MODEL)
TABLE = pieces.load(PATH)


def path_score(ids, text):
    known = {i: s for s, i in TABLE.score.values()}
    return sum(known[i] for i in ids if i in known)


def all_paths(unit):
    """Every segmentation of a unit by its pieces, with its score; for short units."""
    if not unit:
        yield 0.0, ()
        return
    ends = [j for j in range(1, len(unit) + 1) if unit[:j] in TABLE.score]
    if 1 not in ends:
        for score, ids in all_paths(unit[1:]):
            yield score + TABLE.unknown_score, (*TABLE.bytes_of(unit[0]), *ids)
    for j in ends:
        own, i = TABLE.score[unit[:j]]
        for score, ids in all_paths(unit[j:]):
            yield score + own, (i, *ids)


UNITS = ["▁the", "▁hello", "▁ünïc", "▁日本", "▁a1b2", "▁▁▁x", "▁", "▁\n", "q", "▁zzzzz", "▁\x00a", "▁naïve"]


def test_fold_finds_the_best_path(spark):
    found = pieces.fold(pieces.lattice(spark.createDataFrame([(u,) for u in UNITS], "unit string"), TABLE))
    got = {r.unit: r.ids for r in found.collect()}
    assert set(got) == set(UNITS)
    for unit in UNITS:
        scored = {ids: s for s, ids in all_paths(unit)}
        best = max(scored.values())
        assert scored[tuple(got[unit])] == best
        assert got[unit] == pieces.best_path(unit, TABLE)


def test_units_of_a_text():
    assert list(pieces.units("a b")) == ["▁a", "▁b"]
    assert list(pieces.units(" a  b ")) == ["▁▁a", "▁▁b", "▁"]
    assert list(pieces.units("")) == [] and list(pieces.units("a▁b")) == ["▁a", "▁b"]
    rnd = random.Random(1)
    for _ in range(200):
        text = "".join(rnd.choice("ab \n▁") for _ in range(20))
        assert "".join(pieces.units(text)) == pieces.SPACE + text.replace(" ", pieces.SPACE)


def as_unigram(tmp_path):
    """The model with its type set to unigram: the library's own search over these scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_same_as_the_library(tmp_path):
    library = as_unigram(tmp_path)
    rnd = random.Random(5)
    words = ["".join(rnd.choice("etaoin shrdlu") for _ in range(rnd.randint(1, 14))).strip() or "x"
             for _ in range(300)]
    for text in [*words, "Hello world, it is", "naïve café 日本 12345", "a  b   c"]:
        got = [i for u in pieces.units(text) for i in pieces.best_path(u, TABLE)]
        assert got == library.encode(text), text


def test_whole_table_round_trip(spark):
    docs = table(spark, SF, "documents")
    out = pieces.digest(docs).collect()
    assert len(out) == docs.count()
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in out)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in out:
        assert library.decode(r.ids) == text[r.doc_id]


def test_dictionary_does_not_change_results(spark):
    docs = table(spark, SF, "documents")
    few = pieces.encode(docs, dictionary=0).orderBy("doc_id").select("ids").collect()
    assert few == pieces.encode(docs).orderBy("doc_id").select("ids").collect()
    assert pieces.frequent_units(docs, 50).count() <= 50 < pieces.frequent_units(docs).count()


def test_odd_texts(spark):
    texts = [None, "", " ", "   ", "a" * 300_000, "\x00\x01", "tab\tnl\n", "▁mark", "😀 emoji", " lead", "trail "]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x"), (0, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("s")).withColumn("unit", F.lit(1))
    back = pieces.decode(pieces.encode(df)).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back)
    assert all(r.round_trip for r in pieces.digest(df).collect())
    assert pieces.digest(spark.createDataFrame([], DOCS)).collect() == []


def test_ids_are_the_librarys(spark):
    """The model as it is, not switched to unigram: relational fold, merges in the task, whole texts."""
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert library.encode("international") == pieces.segment("▁international", TABLE)
    words = sorted({u for r in table(spark, SF, "documents").collect() for u in pieces.units(r.text)})
    rnd = random.Random(11)
    some = [*UNITS, *rnd.sample([w for w in words if len(w) < pieces.LONGEST_UNIT], 2000)]
    lattices = pieces.lattice(spark.createDataFrame([(u,) for u in some], "unit string"), TABLE)
    for r in pieces.fold_merges(lattices).collect():
        assert r.ids == pieces.merge_path(r.unit, TABLE), r.unit
    texts = ["the international community", "naïve café 日本 12345", "a  b   c    ", "\x00 ▁x", "z" * 5000,
             "".join(rnd.choice("theain▁") for _ in range(5000)), "".join(rnd.choice(words) for _ in range(300))]
    df = table(spark, SF, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], DOCS))
    for r in pieces.encode(df).collect():
        assert r.ids == library.encode(r.text), r.text[:80]


def test_many_units_at_once():
    """The same as one by one, whatever stands in the batch."""
    path = public_tokenizers.path(pieces.MODEL)
    table = pieces.load(path)
    rnd = random.Random(6)
    letters = "aaabcdeeeghinorst▁éßñ日\U0001f600\x00'-."
    parts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    parts += [rnd.choice(list(table.score)) + rnd.choice(list(table.score)) for _ in range(1500)]
    parts += ["▁the", "▁" * 30, "a" * 100, "x"]
    got = pieces.merge_many(parts, path)
    for unit, ids in zip(parts, got, strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == pieces.merge_path(unit, table), unit
    assert pieces.merge_many([], path) == []


def test_a_task_holds_the_units_of_some_texts(monkeypatch):
    """However large the batch: units of few characters at a time, and few of those met before."""
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(40)) for _ in range(200)]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    expected = [[i for u in pieces.units(t) for i in pieces.segment(u, TABLE)] for t in texts]
    held, most, known = [], [], {"▁w1": np.array(pieces.segment("▁w1", TABLE), np.int32).tobytes()}
    cut, solve = pieces.units, pieces._solved
    monkeypatch.setattr(pieces, "_TEXT", 2000)
    monkeypatch.setattr(pieces, "_CACHE", 500)
    monkeypatch.setattr(pieces, "units", lambda text: held.append(len(text)) or cut(text))

    def solved(new, *more):
        most.append(sum(held))
        held.clear()
        return solve(new, *more)

    monkeypatch.setattr(pieces, "_solved", solved)
    (out,) = pieces._encoder(PATH, known)([batch])
    assert out["ids"].to_pylist() == expected
    assert max(most) <= 2000 and len(known) <= 501


def test_parts_are_merged_apart(monkeypatch):
    """Texts are cut where no piece goes on, by blocks, and no other unit is solved."""
    texts = ["the sea,and\nthe sky. ", "", "  x", "naïve日本\U0001f600", "▁a▁▁b", "a" * 50]
    marked = [pieces.SPACE + t.replace(" ", pieces.SPACE) if t else "" for t in texts]
    pairs = {p[i : i + 2] for p in TABLE.score for i in range(len(p) - 1)}
    for block in (1 << 19, 7, 1):
        monkeypatch.setattr(pieces, "_TEXT", block)
        got, ends = pieces.parts_of(texts, PATH)
        got = got.dictionary_decode().to_pylist()
        assert [got[i:j] for i, j in zip([0, *ends], ends, strict=False)] == [
            [p for p in "".join(
                c + ("\x01" if k + 1 == len(t) or t[k : k + 2] not in pairs else "") for k, c in enumerate(t)
            ).split("\x01") if p] for t in marked]
    assert "▁sea" in got and "," in got
    asked, solve = [], pieces._solved
    monkeypatch.setattr(pieces, "_solved", lambda new, *more: asked.extend(new) or solve(new, *more))
    known = {"▁sea": np.array(pieces.segment("▁sea", TABLE), np.int32).tobytes()}
    (out,) = pieces._encoder(PATH, known)([pa.record_batch([pa.array(["sea, sea. sea\nsea"])], names=["text"])])
    assert out["ids"].to_pylist() == [[i for u in pieces.units("sea, sea. sea\nsea") for i in pieces.segment(u, TABLE)]]
    assert not [u for u in asked if "sea" in u and u != "sea"]


def test_frequent_units_are_parts(spark):
    df = spark.createDataFrame([(i, "sea, sky. sea\nsky\u2581 " + "z" * 70) for i in range(9)], DOCS)
    got = {r.unit for r in pieces.frequent_units(df).collect()}
    assert {"▁sea", ",", "▁sky", "."} <= got and "▁sea," not in got and not any("z" in u for u in got)
