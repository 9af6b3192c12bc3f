"""SentencePiece encoding by a relational lattice, and decoding.

No piece joins a character with a space mark after it, so a text splits into units
(space marks and what follows) that are encoded apart; so are the parts of a unit
between characters that stand side by side in no piece (BPE).  Frequent units are encoded
once for the corpus, relationally: their substrings up to the longest piece are
exploded and equi-joined to the piece table, the matches are the edges of a lattice,
grouped by unit, and a higher-order aggregate folds them.  The result is a dictionary
of at most ``DICTIONARY`` units, however large the corpus; the remaining units are
folded where they stand, many at once, over the same pieces and scores.

The ids are SentencePiece's.  For a BPE model, whose scores are merge ranks, the fold
makes the merges: of the edges that join two neighbouring parts the one of most score,
of equal ones the leftmost, until there is none.  For a unigram model it is Viterbi.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, chunks
from tidemark.session import pin

#: Units encoded relationally and sent to all tasks: at most some 20 MB.
DICTIONARY = 200_000
#: Longer units are not looked for among the frequent ones.
LONGEST_UNIT = 64
MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Other units that a task remembers: at most some 20 MB.
_CACHE = 100_000
#: Characters whose units a task has in memory at a time, or one text.
_TEXT = 1 << 19
#: Spans gathered at once.
_IDS = 1 << 16
#: Units of more characters are merged by a heap.
_LONG = 100
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")


@dataclass(frozen=True)
class Pieces:
    """The piece table of a model: a few ten thousand rows."""

    score: dict[str, tuple[float, int]]  # piece -> (score, id)
    text: list[bytes]  # id -> bytes, space marks as spaces
    bytes_from: int | None  # id of byte 0, the others follow; None: no such pieces
    unknown: int
    unknown_score: float
    longest: int
    merges: bool = False  # a BPE model: scores are merge ranks

    @cached_property
    def heads(self) -> frozenset[str]:
        """What pieces begin with; only the search of most score asks for it."""
        return frozenset(p[:k] for p in self.score for k in range(1, len(p) + 1))

    def bytes_of(self, character: str) -> list[int]:
        if self.bytes_from is None:
            return [self.unknown]
        return [self.bytes_from + b for b in character.encode()]


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """Read a model; ValueError if it is neither BPE nor unigram, or joins over space marks."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = pb.ModelProto.FromString(model.serialized_model_proto()).trainer_spec.model_type
    if kind not in (pb.TrainerSpec.BPE, pb.TrainerSpec.UNIGRAM):
        raise ValueError(f"model type {kind} is neither BPE nor unigram")
    score, text, byte_ids = {}, [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids.append(i)
            text.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            text.append(b"" if model.is_control(i) else " ⁇ ".encode())
        else:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} goes on after a space mark")
            score[piece] = (model.get_score(i), i)
            text.append(piece.replace(SPACE, " ").encode())
    in_row = len(byte_ids) == 256 and byte_ids == list(range(byte_ids[0], byte_ids[0] + 256))
    return Pieces(
        score, text, byte_ids[0] if in_row else None, model.unk_id(),
        min(s for s, _ in score.values()) - 10, max(map(len, score)),
        kind == pb.TrainerSpec.BPE,
    )


def best_path(unit: str, pieces: Pieces) -> list[int]:
    """Ids of the segmentation of most score; of equal ones the earliest start wins."""
    n = len(unit)
    best = [-np.inf] * (n + 1)
    best[0] = 0.0
    back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
    heads, score = pieces.heads, pieces.score
    for i in range(n):
        here = best[i]
        single = False
        for j in range(i + 1, min(n, i + pieces.longest) + 1):
            part = unit[i:j]
            if part not in heads:
                break
            found = score.get(part)
            if found:
                single = single or j == i + 1
                if here + found[0] > best[j]:
                    best[j], back[j] = here + found[0], (i, found[1])
        if not single and here + pieces.unknown_score > best[i + 1]:
            best[i + 1], back[i + 1] = here + pieces.unknown_score, (i, -1)
    out: list[list[int]] = []
    at = n
    while at:
        i, piece = back[at]
        out.append([piece] if piece >= 0 else pieces.bytes_of(unit[i:at]))
        at = i
    return [p for part in reversed(out) for p in part]


def merge_path(unit: str, pieces: Pieces) -> list[int]:
    """Ids after all merges: the pair of most score first, of equal ones the leftmost."""
    parts = list(unit) if len(unit) <= _LONG else _merged(unit, pieces)
    score, none = pieces.score, (-np.inf, -1)
    ranks = [score.get(a + b, none)[0] for a, b in zip(parts, parts[1:], strict=False)]
    while ranks and (most := max(ranks)) > -np.inf:
        i = ranks.index(most)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del ranks[i]
        if i:
            ranks[i - 1] = score.get(parts[i - 1] + parts[i], none)[0]
        if i < len(ranks):
            ranks[i] = score.get(parts[i] + parts[i + 1], none)[0]
    out = []
    for part in parts:
        found = score.get(part)
        out += [found[1]] if found else pieces.bytes_of(part)
    return out


def _merged(unit: str, pieces: Pieces) -> list[str]:
    """The parts of a long unit after all merges, by a heap of pairs."""
    n, score = len(unit), pieces.score
    end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here
    before = list(range(-1, n))
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and end[j] - i <= pieces.longest and (found := score.get(unit[i : end[j]])):
            heapq.heappush(heap, (-found[0], i, j, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or end[j] != k:
            continue
        end[i], end[j] = k, 0
        before[k] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [unit[i : end[i]] for i in range(n) if end[i]]


def segment(unit: str, pieces: Pieces) -> list[int]:
    """Ids of a unit as the model's own algorithm gives them."""
    return merge_path(unit, pieces) if pieces.merges else best_path(unit, pieces)


def units(text: str) -> list[str]:
    """The units of a text, the mark at its start included; an empty text has none."""
    if not text:
        return []
    if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return (SPACE + text.replace(" ", f" {SPACE}")).split(" ")
    return _UNIT.findall(SPACE + text.replace(" ", SPACE))


def _counted_parts(path: str):
    """The parts of words, with the words' counts."""

    def run(batches):
        for batch in batches:
            words = batch["word"].to_pylist()
            parts, ends = parts_of(words, path)
            count = np.repeat(batch["count"].to_numpy(), np.diff(ends, prepend=0))
            yield pa.record_batch(
                [parts.dictionary_decode(), pa.array(count, pa.int64())], names=["unit", "count"]
            )

    return run


def frequent_units(docs: DataFrame, most: int = DICTIONARY, model: str | None = None) -> DataFrame:
    """(unit) of parts that stand most often in repeated words: at most ``most``, whole classes of counts."""
    words = docs.select(F.explode(F.split("text", " ")).alias("word")).where(
        # The characters are counted once for each different word, below.
        (F.col("word") != "") & (F.octet_length("word") < 4 * LONGEST_UNIT)
    )
    repeated = words.groupBy("word").count().where(
        (F.col("count") >= 8) & (F.char_length("word") < LONGEST_UNIT)
        & ~F.contains("word", F.lit(SPACE))
    )
    parts = arrow(
        repeated, _counted_parts(model or public_tokenizers.path(MODEL)), "unit string, count long"
    )
    counts = pin(
        parts.groupBy("unit").agg(F.sum("count").alias("count"))
        .select("unit", F.floor(F.log2("count")).alias("size")),
        "words",
    )
    # At most 64 rows.
    sizes = sorted(counts.groupBy("size").count().collect(), key=lambda r: -r["size"])
    least, total = 64, 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row["size"]
    return counts.where(F.col("size") >= least).select("unit")


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    rows = pa.table(
        {
            "piece": pa.array(list(pieces.score), pa.string()),
            "score": pa.array([s for s, _ in pieces.score.values()], pa.float64()),
            "id": pa.array([i for _, i in pieces.score.values()], pa.int32()),
        }
    )
    return spark.createDataFrame(rows)


def lattice(unit_rows: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, edges): every piece in a unit as (end, start, score, ids).

    A character that is no piece has an edge with its bytes.
    """
    table = piece_table(unit_rows.sparkSession, pieces)
    n = F.char_length("unit")
    starts = unit_rows.select("unit", F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    longest = F.least(F.lit(pieces.longest), F.char_length("unit") - F.col("start"))
    parts = starts.select(
        "unit", "start", F.explode(F.sequence(F.lit(1), longest)).alias("size")
    ).withColumn("part", F.substring("unit", F.col("start") + 1, F.col("size")))
    hexed = F.hex(F.encode("part", "utf-8"))
    if pieces.bytes_from is None:
        unknown = F.array(F.lit(pieces.unknown))
    else:
        unknown = F.transform(
            F.sequence(F.lit(1), F.length(hexed) - 1, F.lit(2)),
            lambda k: F.conv(F.substring(hexed, k, F.lit(2)), 16, 10).cast("int") + pieces.bytes_from,
        )
    edge = F.struct(
        (F.col("start") + F.col("size")).alias("end"),
        "start",
        F.coalesce("score", F.lit(pieces.unknown_score)).alias("score"),
        F.when(F.col("id").isNull(), unknown).otherwise(F.array("id")).alias("ids"),
    )
    return (
        # The piece table has the model's size, whatever the corpus.
        parts.join(F.broadcast(table), parts["part"] == table["piece"], "left")
        .where("id is not null or size = 1")
        .groupBy("unit")
        .agg(F.collect_list(edge).alias("edges"))
    )


def fold(lattices: DataFrame) -> DataFrame:
    """(unit, ids): Viterbi as a fold over the ends of a unit's edges."""

    def step(state, end):
        arriving = F.filter("edges", lambda e: e["end"] == end)
        candidates = F.transform(
            arriving,
            lambda e: F.struct(
                (F.get(state, e["start"])["score"] + e["score"]).alias("score"),
                (-e["start"]).alias("early"),
                F.concat(F.get(state, e["start"])["ids"], e["ids"]).alias("ids"),
            ),
        )
        return F.array_append(state, F.array_max(candidates))

    start = F.expr(
        "array(named_struct('score', 0D, 'early', 0, 'ids', cast(array() as array<int>)))"
    )
    ends = F.sequence(F.lit(1), F.char_length("unit"))
    best = F.aggregate(ends, start, step, lambda state: F.element_at(state, -1)["ids"])
    return lattices.select("unit", best.alias("ids"))


def fold_merges(lattices: DataFrame) -> DataFrame:
    """(unit, ids): the merges of a unit as a fold; the state is the bounds of its parts."""
    wide = F.filter("edges", lambda e: e["end"] - e["start"] > 1)

    def step(state, _):
        def place(e):
            return F.array_position(state, e["start"]).cast("int")

        # Edges over two neighbouring parts: their end is the second bound after their start.
        joins = F.filter(
            "wide", lambda e: (place(e) > 0) & (F.get(state, place(e) + 1) == e["end"])
        )
        best = F.array_max(
            F.transform(
                joins,
                lambda e: F.struct(
                    e["score"].alias("score"), (-e["start"]).alias("early"),
                    F.get(state, place(e)).alias("inner"),
                ),
            )
        )
        return F.coalesce(F.array_remove(state, best["inner"]), state)

    n = F.char_length("unit")
    bounds = F.aggregate(F.sequence(F.lit(1), n), F.sequence(F.lit(0), n), step)
    part = F.transform(
        F.slice("bounds", 1, F.size("bounds") - 1),
        lambda start, i: F.get(
            F.filter("edges", lambda e: (e["start"] == start) & (e["end"] == F.get("bounds", i + 1))), 0
        )["ids"],
    )
    return (
        lattices.withColumn("wide", wide).withColumn("bounds", bounds)
        .select("unit", F.flatten(part).alias("ids"))
    )


@dataclass(frozen=True)
class Merges:
    """Two symbols and the one they make, for all pieces; symbols are piece ids, then characters."""

    chars: np.ndarray  # code points, sorted
    symbol: np.ndarray  # of each
    pairs: np.ndarray  # left * size + right, sorted
    made: np.ndarray  # of each
    rank: np.ndarray  # of each piece id: higher is merged first
    size: int
    maybe: np.ndarray  # by a hash of a pair: is there one

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs of symbols make; -1: nothing.  Symbols may be -1."""
        pair = left * self.size + right
        out = np.full(len(pair), -1, np.int64)
        likely = np.flatnonzero(self.maybe[_slot(pair)] & (left >= 0) & (right >= 0))
        pair = pair[likely]
        k = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        out[likely] = np.where(self.pairs[k] == pair, self.made[k], -1)
        return out


def _slot(pair: np.ndarray) -> np.ndarray:
    return (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)


@lru_cache(maxsize=4)
def merge_table(path: str) -> Merges:
    pieces = load(path)
    score = pieces.score
    loose = sorted({c for p in score for c in p if c not in score})
    number = {p: i for p, (_, i) in score.items()} | {c: len(pieces.text) + k for k, c in enumerate(loose)}
    size = len(pieces.text) + len(loose)
    made = {}
    for piece, (_, i) in score.items():
        for k in range(1, len(piece)):
            left, right = number.get(piece[:k]), number.get(piece[k:])
            if left is not None and right is not None:
                made[left * size + right] = i
    pairs = np.array(sorted(made), np.int64)
    rank = np.full(size, -1, np.int64)
    ids = np.array([i for _, i in score.values()])
    rank[ids] = np.unique([s for s, _ in score.values()], return_inverse=True)[1]
    points = sorted((ord(p), i) for p, i in number.items() if len(p) == 1)
    maybe = np.zeros(1 << 21, bool)
    maybe[_slot(pairs)] = True
    return Merges(
        np.array([c for c, _ in points]), np.array([i for _, i in points]),
        pairs, np.array([made[int(p)] for p in pairs], np.int64), rank, size, maybe,
    )


def merge_many(parts: list[str], path: str) -> list[bytes]:
    """``merge_path`` of many units at once, as 32-bit ids: each step merges one pair in each unit."""
    table, pieces = merge_table(path), load(path)
    if not parts:
        return []
    text = "".join(parts)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    at = np.minimum(np.searchsorted(table.chars, code), len(table.chars) - 1)
    symbol = np.where(table.chars[at] == code, table.symbol[at], -1)
    length = np.array([len(p) for p in parts])
    unit = np.arange(len(parts))
    last = np.zeros(len(symbol), bool)
    last[np.cumsum(length) - 1] = True

    def joined(places: np.ndarray) -> np.ndarray:
        """What symbols at these places make with the next one; -1: nothing."""
        right = symbol[np.minimum(places + 1, len(symbol) - 1)]
        return table.of(symbol[places], np.where(last[places], -1, right))

    # Where a symbol began, and by that what a step looks for: the highest rank, of equal ones
    # the leftmost.
    begin = np.arange(len(symbol))
    low = (1 << 32) - 1
    makes = joined(begin)
    value = np.where(makes >= 0, (table.rank[makes] << 32) | (low - begin), -1)
    done: list[tuple[np.ndarray, ...]] = []
    while len(unit):
        first = np.cumsum(length) - length
        best = np.maximum.reduceat(value, first)
        active = best >= 0
        if not active.all():
            own = np.repeat(active, length)
            done.append((unit[~active], length[~active], symbol[~own], begin[~own]))
            symbol, makes, value, begin, last = symbol[own], makes[own], value[own], begin[own], last[own]
            unit, length, best = unit[active], length[active], best[active]
            if not len(unit):
                break
        place = np.searchsorted(begin, low - (best & low))
        symbol[place] = makes[place]
        last[place] = last[place + 1]
        keep = np.ones(len(symbol), bool)
        keep[place + 1] = False
        symbol, makes, value, begin, last = symbol[keep], makes[keep], value[keep], begin[keep], last[keep]
        place -= np.arange(len(place))  # one symbol went in every unit ahead
        length = length - 1
        first = np.cumsum(length) - length
        changed = np.concatenate([place, place[place > first] - 1])
        made = joined(changed)
        makes[changed] = made
        value[changed] = np.where(made >= 0, (table.rank[made] << 32) | (low - begin[changed]), -1)
    units_done, lengths, ids, begin = (np.concatenate(c) for c in zip(*done, strict=True))
    cut = np.concatenate(([0], np.cumsum(lengths)))
    # Characters that are no piece become bytes.
    odd = np.flatnonzero((ids < 0) | (ids >= len(pieces.text)))
    strange = set((np.searchsorted(cut, odd, side="right") - 1).tolist())
    data = ids.astype(np.int32).tobytes()
    out: list[bytes] = [b""] * len(parts)
    for k, (u, i, j) in enumerate(zip(units_done.tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if k not in strange:
            out[u] = data[4 * i : 4 * j]
            continue
        found = array("i")
        for one, at in zip(ids[i:j].tolist(), begin[i:j].tolist(), strict=True):
            found.extend([one] if 0 <= one < len(pieces.text) else pieces.bytes_of(text[at]))
        out[u] = found.tobytes()
    return out


@lru_cache(maxsize=4)
def inner_pairs(path: str) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character (0: in no piece), and by two numbers: may they stand side by side in a piece."""
    score = load(path).score
    number = np.zeros(0x110000, np.int32)
    points = sorted({ord(c) for p in score for c in p})
    number[points] = np.arange(1, len(points) + 1)
    inner = np.zeros((len(points) + 1, len(points) + 1), bool)
    for a, b in {p[i : i + 2] for p in score for i in range(len(p) - 1)}:
        inner[number[ord(a)], number[ord(b)]] = True
    return number, inner


def parts_of(texts: list[str], path: str) -> tuple[pa.DictionaryArray, np.ndarray]:
    """What texts are cut into, one after another, and how many parts there are up to the end of each.

    Parts of a unigram model are the units.  For a BPE model these are cut again wherever no piece
    goes on: nothing is merged over such a place, so that parts are merged apart.
    """
    text = "".join(SPACE + t.replace(" ", SPACE) if t else "" for t in texts)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 if t else 0 for t in texts])
    end = np.zeros(len(code), bool)
    merges = load(path).merges
    for k in range(0, len(code), _TEXT):
        some = code[k : k + _TEXT + 1]
        if merges:
            number, inner = inner_pairs(path)
            some = number[some]
            apart = ~inner[some[:-1], some[1:]]
        else:
            apart = (some[:-1] != ord(SPACE)) & (some[1:] == ord(SPACE))
        end[k : k + len(apart)] = apart
    end[ends[ends > 0] - 1] = True
    last = np.flatnonzero(end)
    width = 1 + (code >= 0x80).astype(np.uint8) + (code >= 0x800) + (code >= 0x10000)
    offsets = np.concatenate(([0], np.cumsum(width, dtype=np.int32)[last])).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(last), pa.py_buffer(offsets), pa.py_buffer(text.encode()))
    return parts.dictionary_encode(), np.searchsorted(last, ends)


def _gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """``values`` of the spans ``which``, one after another; some at once."""
    out = [values[:0]]
    for k in range(0, len(which), _IDS):
        some = which[k : k + _IDS]
        n = size[some]
        out.append(values[np.arange(int(n.sum())) + np.repeat(start[some] - np.cumsum(n) + n, n)])
    return np.concatenate(out)


#: Units solved at once.
_MANY = 20_000


def _solved(new: list[str], path: str, pieces: Pieces) -> Iterator[tuple[str, bytes]]:
    """Ids of units that are not in the dictionary."""
    if not pieces.merges:
        for unit in new:
            yield unit, array("i", segment(unit, pieces)).tobytes()
        return
    short = [u for u in new if len(u) <= _LONG]
    for k in range(0, len(short), _MANY):
        yield from zip(short[k : k + _MANY], merge_many(short[k : k + _MANY], path), strict=True)
    for unit in new:
        if len(unit) > _LONG:
            yield unit, array("i", segment(unit, pieces)).tobytes()


def _encoder(path: str, known: dict[str, bytes]):
    def run(batches):
        pieces = load(path)
        # The task's own copy; what it adds is in ``recent``.
        ids_of = known
        recent: set[str] = set()

        def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Ids of the texts, one after another, and how many each has."""
            parts, ends = parts_of(texts, path)
            names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
            which = parts.indices.to_numpy()
            found = list(map(ids_of.get, names))
            missing = [k for k, ids in enumerate(found) if ids is None]
            new = dict(_solved([names[k] for k in missing], path, pieces))
            for k in missing:
                found[k] = new[names[k]]
            if len(recent) + len(new) > _CACHE:
                for u in recent:
                    del ids_of[u]
                recent.clear()
            # Long units are not worth keeping.
            new = {u: ids for u, ids in new.items() if len(u) <= LONGEST_UNIT}
            ids_of.update(new)
            recent.update(new)
            size = np.array([len(ids) for ids in found], np.int64) // 4
            ids = _gathered(np.frombuffer(b"".join(found), np.int32), np.cumsum(size) - size, size, which)
            return ids, np.diff(np.concatenate(([0], np.cumsum(size[which])))[ends], prepend=0)

        for batch in batches:
            texts = [text or "" for text in batch["text"].to_pylist()]
            out = [encoded(texts[i:j]) for i, j in chunks(texts, _TEXT)]
            values, sizes = map(np.concatenate, zip(*out, strict=True)) if out else (np.zeros(0, np.int32), [])
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            yield pa.record_batch(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=[*batch.schema.names, "ids"],
            )

    return run


def _schema(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)


def encode(docs: DataFrame, model: str | None = None, dictionary: int = DICTIONARY) -> DataFrame:
    """``docs`` with ``ids`` (array of int, replacing a column of that name).

    NULL and empty texts have no ids.  Spaces are kept as they are, one is put first;
    characters outside the vocabulary become byte pieces.
    """
    path = model or public_tokenizers.path(MODEL)
    pieces = load(path)
    solve = fold_merges if pieces.merges else fold
    solved = solve(lattice(frequent_units(docs, dictionary, path), pieces)).toArrow()
    ids = solved["ids"].to_pylist()
    known = {u: array("i", i).tobytes() for u, i in zip(solved["unit"].to_pylist(), ids, strict=True)}
    docs = docs.drop("ids")
    return arrow(docs, _encoder(path, known), f"{_schema(docs)}ids array<int>")


def _decoder(path: str):
    def run(batches):
        text = load(path).text
        blob = np.frombuffer(b"".join(text), np.uint8)
        size = np.array([len(t) for t in text])
        start = np.cumsum(size) - size

        for batch in batches:
            column = batch["ids"]
            cut = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False)
            none = column.is_null().to_numpy(zero_copy_only=False)
            out = []
            for k, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                whole = b"" if none[k] else _gathered(blob, start, size, flat[i:j]).tobytes()
                # The space that encoding puts first.
                out.append(whole.removeprefix(b" ").decode("utf-8", "replace"))
            yield pa.record_batch(
                [*batch.columns, pa.array(out, pa.string())],
                names=[*batch.schema.names, "decoded"],
            )

    return run


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """With ``decoded``, the text of ``ids``; NULL ids are an empty text."""
    path = model or public_tokenizers.path(MODEL)
    encoded = encoded.drop("decoded")
    return arrow(encoded, _decoder(path), f"{_schema(encoded)}decoded string")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_ids, ids, round_trip): the ids of whole texts, and whether they decode to them.

    A space mark in the text itself comes back as a space; such texts are compared so.
    """
    back = decode(encode(docs.select("doc_id", "text")))
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(SPACE), F.lit(" "))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
        (F.col("decoded") == text).alias("round_trip"),
    )
