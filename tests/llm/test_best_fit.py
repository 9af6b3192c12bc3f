import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from tokenizers import Tokenizer

from tidemark.llm import best_fit
from tidemark.llm.common import table

DOCS = "doc_id long, text string"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(docs, pieces, window=1024):
    """The contract, piece by piece; returns the sequences."""
    want = {}
    for d, t in docs:
        want.setdefault(d, []).append(TOKENIZER.encode(t or "", add_special_tokens=False).ids + [2])
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.piece, p.start, p.length, p.ids_crc32))
        by_sequence.setdefault(p.sequence_id, []).append(p)
    expected = {}
    for d, texts in want.items():
        for ids in texts:
            rest, cuts = len(ids) % window, []
            if rest:
                cuts.append((0, rest))
            cuts += [(k, window) for k in range(rest, len(ids), window)]
            expected.setdefault(d, []).extend(
                (k, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for k, (a, n) in enumerate(cuts)
            )
    assert {d: sorted(p) for d, p in by_doc.items()} == {d: sorted(p) for d, p in expected.items()}
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return len(by_sequence), -(-sum(len(i) for t in want.values() for i in t) // window)


def test_whole_table(spark):
    df = table(spark, SF, "documents").repartition(7)
    out = best_fit.pack(df)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    bins, least = check([(r.doc_id, r.text) for r in df.collect()], out.collect())
    assert bins <= least * 1.02 + 1


def test_odd_texts(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (None, "no id"), (4, "same"), (4, "same"), (5, "a b c " * 4000),
            (6, "<|endoftext|> x"), (7, " the" * 1023), (8, " the" * 1024), (9, " the" * 2047), (10, "é😀" * 900)]
    df = spark.createDataFrame([(*d, 5) for d in docs], DOCS + ", size long").repartition(5)
    check(docs, best_fit.pack(df).collect())


def test_empty_table(spark):
    assert best_fit.pack(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_item_once(seed):
    rnd = random.Random(seed)
    window = rnd.choice([8, 64, 1024])
    sizes = [min(window - 1, max(1, int(rnd.paretovariate(0.7)))) for _ in range(3000)]
    count = np.bincount(sizes, minlength=window + 1)
    used = np.zeros(window + 1, np.int64)
    bins = 0
    for filling, times in best_fit.plan(count, window):
        assert sum(filling) <= window and times > 0 and filling == sorted(filling, reverse=True)
        np.add.at(used, filling, times)
        bins += times
    assert (used == count).all()
    # Never worse than first fit, largest first.
    rooms = []
    for s in sorted(sizes, reverse=True):
        for k, room in enumerate(rooms):
            if room >= s:
                rooms[k] -= s
                break
        else:
            rooms.append(window - s)
    assert -(-sum(sizes) // window) <= bins <= len(rooms)


def test_smallest_is_replaced_by_two():
    # Greedy takes 6 and 3, gap 1; 2 and 2 fill the place of 3 to the end.
    count = np.zeros(11, np.int64)
    count[[6, 3, 2]] = 1, 1, 2
    assert best_fit.plan(count, 10) == [([6, 2, 2], 1), ([3], 1)]


def brute_two(count, above, room):
    items = [s for s in range(len(count)) for _ in range(min(2, count[s]))]
    sums = [a + b for i, a in enumerate(items) for b in items[i + 1 :] if above < a + b <= room]
    return max(sums, default=None)


def test_two_fit_tightest():
    rnd = random.Random(9)
    for _ in range(500):
        count = np.array([0, *(rnd.choice([0, 0, 1, 2]) for _ in range(20))])
        room = rnd.randint(2, 20)
        above = rnd.randint(1, room)
        pair = best_fit._two(count, above, room)
        assert (sum(pair) if pair else None) == brute_two(count, above, room)
