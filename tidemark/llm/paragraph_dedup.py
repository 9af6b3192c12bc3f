"""Near-duplicate paragraphs by MinHash banding.

A paragraph is what stands between two sentence ends or line breaks; where there is none
for ``LONG`` words, words chosen by their hash end one.  So it does not depend on what
stands around it, and a passage copied into the middle of a line is found by the sentences
it has.  A paragraph's signature is cut into bands; paragraphs with an equal band collide,
their whole shingle sets are compared (Jaccard of at least 0.8 on five-word shingles; fewer
words are one shingle), and links make components, of which the first paragraph stays.

Repeated paragraphs that follow each other are a passage if they have ``PASSAGE`` words
together; others (a licence line, a heading) are reported apart.

Equal shingle sets are one *class* from the start.  As in any list of thousands of
alike paragraphs, not all pairs are made: each member of a band's list is compared
with one star of it, and then only pairs across the components found so far.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, chunks, keyed, mix, texts_of
from tidemark.llm.graph import components
from tidemark.llm.shingles import PLACE, SIZE, linked, plain_set, word_spans
from tidemark.session import pin

THRESHOLD = 0.8
#: Share of pairs at the threshold that must collide.
RECALL = 0.9995
#: Words after which a paragraph may end anywhere, and one in so many of them ends it.
LONG, ENDS = 64, 16
#: Words of a passage.
PASSAGE = 20
_CHUNK = 1 << 18
#: Classes a task remembers.
_SEEN = 1 << 18
_U = np.uint64


def tune(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 5) -> tuple[int, int]:
    """(bands, rows): as many rows as the recall allows with at most ``most`` bands, 1 at least.

    Paragraphs that have nothing to do with each other share no shingle of five words, so
    single rows keep them apart already.
    """
    rows = 1
    while True:
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if int(np.ceil(np.log(1 - recall) / np.log(1 - threshold ** (rows + 1)))) > most:
            return bands, rows
        rows += 1


BANDS, ROWS = tune()
_SEED = mix(np.arange(101, 101 + BANDS * ROWS, dtype=_U))
_FACTOR = mix(np.arange(901, 901 + BANDS * ROWS, dtype=_U)) | _U(1)
#: Sets of fewer shingles are similar only if they are equal.
_LEAST = 4


def signature(tokens: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash for each band of each set; sets follow each other from their ``start`` on."""
    out = np.zeros((len(start), BANDS), _U)
    for k in range(BANDS * ROWS):
        least = np.minimum.reduceat((tokens ^ _SEED[k]) * _FACTOR[k], start)
        band = k // ROWS
        out[:, band] = mix(out[:, band] + least + _U(band + 1))
    return out


@dataclass
class Paragraphs:
    """The paragraphs of some texts: the text of each, its number there, words, bytes, shingle set."""

    text: np.ndarray
    number: np.ndarray
    words: np.ndarray
    begin: np.ndarray  # bytes from the start of the text
    tokens: np.ndarray  # sets one after another, each sorted
    first: np.ndarray  # where the set of each begins
    size: np.ndarray

    @property
    def cls(self) -> np.ndarray:
        """A signed 64-bit hash of each set, its size included."""
        if not len(self.first):
            return np.zeros(0, np.int64)
        total = np.add.reduceat(mix(self.tokens ^ _U(0x5851F42D4C957F2D)), self.first)
        return mix(total + self.size.astype(_U)).view(np.int64)


def parities(tokens: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64 bits of each set: parities of its tokens by a hash.

    Two sets differ in no more bits than tokens, which sifts pairs before whole sets move.
    """
    bit = _U(1) << (mix(tokens + _U(77)) & _U(63))
    return np.bitwise_xor.reduceat(bit, start).view(np.int64)


def _windows(text: bytes) -> Iterator[bytes]:
    """A huge text cut behind line breaks, or else sentence ends, blanks, or not at all."""
    at = 0
    while len(text) - at > 2 * _CHUNK:
        for mark in (b"\n", b". ", b" "):
            cut = text.rfind(mark, at, at + _CHUNK)
            if cut < 0 and mark == b" ":  # a word longer than a window
                cut = text.find(mark, at + _CHUNK)
            if cut >= 0:
                break
        if cut < 0:
            break
        cut += len(mark)
        yield text[at:cut]
        at = cut
    yield text[at:]


def paragraphs(texts: list[bytes]) -> Iterator[Paragraphs]:
    """In order; a huge text comes in several parts, whose numbers go on."""
    for lo, hi in chunks(texts, _CHUNK):
        if len(texts[lo]) <= 2 * _CHUNK:
            yield _paragraphs(texts[lo:hi], lo, 0, 0)
            continue
        number = offset = 0
        for part in _windows(texts[lo]):
            found = _paragraphs([part], lo, number, offset)
            yield found
            number, offset = number + len(found.text), offset + len(part)


def _paragraphs(texts: list[bytes], base: int, number: int, offset: int) -> Paragraphs:
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start, end, words = word_spans(buf)
    none = np.zeros(0, np.int64)
    if not len(words):
        return Paragraphs(none, none, none, none, words, none, none)
    # A word ends a paragraph if a sentence or its line ends with it.
    last = buf[end - 1]
    ends = (last == 0x2E) | (last == 0x21) | (last == 0x3F)
    lines = np.cumsum(buf == 0x0A)
    ends[:-1] |= lines[start[1:]] > lines[end[:-1] - 1]
    ends[-1] = True

    def bounds() -> tuple[np.ndarray, np.ndarray]:
        to = np.flatnonzero(ends) + 1
        first = np.concatenate(([0], to[:-1]))
        return first, to - first

    first, count = bounds()
    if (count > LONG).any():
        ends |= np.repeat(count > LONG, count) & (words % _U(ENDS) == 0)
        first, count = bounds()
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    text = np.searchsorted(begins, start[first], side="right") - 1
    own = np.arange(len(first)) - np.searchsorted(text, np.arange(len(texts)))[text]
    tokens, owner = _shingles(words, first, count)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[keep], owner[keep]
    at = np.searchsorted(owner, np.arange(len(first)))
    size = np.diff(np.append(at, len(tokens)))
    return Paragraphs(text + base, own + number, count, start[first] - begins[text] + offset, tokens, at, size)


def _shingles(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the paragraph of each."""
    owner = np.repeat(np.arange(len(first)), count)
    inner = np.arange(len(words)) - first[owner]
    few = count < SIZE
    # All words of a short paragraph are one shingle.
    short = few[owner]
    total = np.where(short, words * PLACE[np.minimum(inner, SIZE - 1)], _U(0))
    one = mix(np.add.reduceat(total, first) + count.astype(_U))[few]
    n = len(words) - SIZE + 1
    if n <= 0:
        return one, np.flatnonzero(few)
    five = words[:n] * PLACE[0]
    for k in range(1, SIZE):
        five += words[k : k + n] * PLACE[k]
    whole = inner[:n] + SIZE <= count[owner[:n]]
    return np.concatenate([one, mix(five[whole])]), np.concatenate([np.flatnonzero(few), owner[:n][whole]])


def _members(batches):
    """A row for each paragraph, and one with no class for each document."""
    for batch in batches:
        doc, tie = batch["doc"].to_numpy(), batch["tie"].to_numpy()
        texts = texts_of(batch["text"])
        n = np.zeros(len(texts), np.int64)
        for p in paragraphs(texts):
            if len(p.text):
                n += np.bincount(p.text, minlength=len(texts))
                yield _member_rows(doc[p.text], tie[p.text], p.number, pa.array(p.cls), p.words)
        yield _member_rows(doc, tie, np.full(len(texts), -1), pa.nulls(len(texts), pa.int64()), n)


def _member_rows(doc, tie, para, cls, words) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(doc), pa.array(tie), pa.array(para.astype(np.int32)), cls, pa.array(words.astype(np.int32))],
        names=["doc", "tie", "para", "cls", "words"],
    )


def _bands(batches):
    seen = np.zeros(0, np.int64)
    for batch in batches:
        for p in paragraphs(texts_of(batch["text"])):
            cls = p.cls
            able = p.size >= _LEAST
            if len(seen):
                able &= seen[np.minimum(np.searchsorted(seen, cls), len(seen) - 1)] != cls
            pick = np.flatnonzero(able)
            pick = pick[np.unique(cls[pick], return_index=True)[1]]
            if not len(pick):
                continue
            if len(seen) < _SEEN:  # only saves rows: repeated ones are merged later
                seen = np.union1d(seen, cls[pick])
            size = p.size[pick]
            start = np.cumsum(size) - size
            at = np.arange(size.sum()) + np.repeat(p.first[pick] - start, size)
            bands = signature(p.tokens[at], start)
            yield pa.record_batch(
                [pa.array(bands.ravel().view(np.int64)), pa.array(np.repeat(cls[pick], BANDS)),
                 pa.array(np.repeat(size, BANDS).astype(np.int32)),
                 pa.array(np.repeat(parities(p.tokens[at], start), BANDS))],
                names=["band", "cls", "n", "bits"],
            )


def _sets(batches):
    for batch in batches:
        wanted = [np.array(sorted(set(w)), np.int64) for w in batch["paras"].to_pylist()]
        cls, tokens = [], []
        for p in paragraphs(texts_of(batch["text"])):
            of_class = p.cls
            key = (p.text.astype(np.int64) << 32) | p.number
            keys = np.concatenate([(np.int64(t) << 32) | wanted[t] for t in np.unique(p.text)]) if len(key) else key
            for i in np.flatnonzero(np.isin(key, keys)).tolist():
                cls.append(int(of_class[i]))
                tokens.append(p.tokens[p.first[i] : p.first[i] + p.size[i]].tobytes())
        yield pa.record_batch(
            [pa.array(cls, pa.int64()), pa.array(tokens, pa.binary())], names=["cls", "tokens"]
        )


def _compare(batches):
    for batch in batches:
        good = []
        for a, b in zip(batch["ta"].to_pylist(), batch["tb"].to_pylist(), strict=True):
            x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * both >= 80 * (len(x) + len(y) - both))
        keep = pa.array(good, pa.bool_())
        yield pa.record_batch([batch["a"].filter(keep), batch["b"].filter(keep)], names=["a", "b"])


def _verified(pairs: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are similar."""
    pairs = pin(pairs.distinct(), "pairs")
    classes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    # One paragraph of each class; paragraphs of a document together.
    wanted = pin(
        members.join(classes, "cls", "left_semi")
        .groupBy("cls").agg(F.min(F.struct("doc", "tie", "para")).alias("p"))
        .groupBy("p.doc", "p.tie").agg(F.collect_list("p.para").alias("paras")),
        "wanted",
    )
    # Both sides of these joins grow with the corpus: always by a shuffle.
    texts = docs.select("doc", "tie", "text").join(wanted.hint("merge"), ["doc", "tie"])
    sets = pin(
        arrow(texts.select("text", "paras"), _sets, "cls long, tokens binary").dropDuplicates(["cls"]),
        "sets",
    )
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.hint("merge").join(left, "a").join(right.hint("merge"), "b")
    return pin(arrow(both.select("a", "b", "ta", "tb"), _compare, "a long, b long"), "links")


def _able(n: str, m: str, bits: str, other: str) -> Column:
    """Whether sets of n and m shingles can be similar.

    Similar ones have sizes of a ratio of 0.8 and more and differ in at most (n + m) / 9.
    """
    differ = F.bit_count(F.col(bits).bitwiseXOR(F.col(other)))
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * differ <= F.col(n) + F.col(m))


def duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, repeats) of rows of :func:`keyed`.

    members: doc, tie, para (number of the paragraph, or -1 for the document itself, whose
    words are its paragraphs), cls, words.
    repeats: doc, tie, para, words, doc_kept, passage: paragraphs to remove, the document
    that keeps the first of their component, and the words of the passage they are in.
    """
    # Rows equal in both are one document; only rows of ids that stand on several have a tie.
    rows = docs.select("doc", "tie", "text")
    rows = rows.where("tie = 0").unionByName(rows.where("tie <> 0").dropDuplicates(["doc", "tie"]))
    members = pin(
        arrow(rows, _members, "doc long, tie long, para int, cls long, words int"), "paragraphs"
    )
    of_band = Window.partitionBy("band")
    bands = arrow(docs.select("text"), _bands, "band long, cls long, n int, bits long")
    lists = pin(
        bands.repartition("band").dropDuplicates(["band", "cls"])
        .withColumn("size", F.count("*").over(of_band)).where("size > 1").drop("size"),
        "bands",
    )
    # The star of a list is the member that others share most bands with, as an original
    # has among its edited copies.
    own = lists.groupBy("cls").agg((-F.count("*")).alias("own"))
    starred = lists.join(own.hint("merge"), "cls").withColumn(
        "star", F.min(F.struct("own", "cls", "n", "bits")).over(of_band)
    )
    stars = (
        starred.where(F.col("cls") != F.col("star.cls"))
        .where(_able("n", "star.n", "bits", "star.bits"))
        .groupBy(F.col("star.cls").alias("a"), F.col("cls").alias("b"))
        .agg(F.count("*").alias("shared"))
    )
    first = _verified(
        stars.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b"),
        members, docs,
    )
    roots = components(first)
    known = lists.join(roots.hint("merge"), F.col("cls") == F.col("node"), "left").select(
        "band", "cls", "n", "bits", F.coalesce("root", "cls").alias("root")
    )
    mixed = pin(
        known.select("*", F.min("root").over(of_band).alias("low"), F.max("root").over(of_band).alias("high"))
        .where("low <> high"),
        "mixed",
    )

    def side(name: str, df: DataFrame, *more: str) -> DataFrame:
        return df.select("band", *more, *(F.col(c).alias(f"{name}_{c}") for c in ("cls", "n", "bits", "root")))

    across = (
        side("x", mixed.where("root <> low")).join(side("y", mixed, "low"), "band")
        .where("x_root <> y_root and (y_root = low or x_cls < y_cls)")
        .where(_able("x_n", "y_n", "x_bits", "y_bits"))
        .select(F.least("x_cls", "y_cls").alias("a"), F.greatest("x_cls", "y_cls").alias("b"))
    )
    second = _verified(across, members, docs)
    roots = components(
        roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(second)
    )
    linked_classes = roots.select(F.col("node").alias("cls"), "root")
    placed = members.where("cls is not null").join(linked_classes.hint("merge"), "cls", "left").select(
        "doc", "tie", "para", "words", F.coalesce("root", "cls").alias("comp")
    )
    # Most paragraphs stand once.  Written lists, so Spark can split the joins where one
    # paragraph stands in very many documents.
    often = pin(placed.groupBy("comp").count().where("count > 1").select("comp"), "often")
    again = pin(placed.join(often.hint("merge"), "comp"), "again")
    place = F.struct("doc", "tie", "para")
    kept = pin(again.groupBy("comp").agg(F.min(place).alias("kept")), "kept")
    found = again.join(kept.hint("merge"), "comp").where(place != F.col("kept")).select(
        "doc", "tie", "para", "words", F.col("kept.doc").alias("doc_kept")
    )
    # Repeated paragraphs that follow each other are one passage.
    of_doc = Window.partitionBy("doc", "tie")
    runs = found.withColumn("run", F.col("para") - F.row_number().over(of_doc.orderBy("para")))
    repeats = runs.withColumn("passage", F.sum("words").over(Window.partitionBy("doc", "tie", "run"))).drop("run")
    return members, repeats


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, n_removed, removed, kept_in, n_short, removed_short) for each distinct document.

    ``removed`` are numbers, from 0, of the paragraphs in repeated passages, ``kept_in`` the
    doc_id that keeps each of them (NULL if that document has none); ``removed_short`` those
    of repeated paragraphs that make no passage.  NULL texts and those without words have no
    paragraph.  Rows equal in id and text are one row.
    """
    members, repeats = duplicates(keyed(docs.select("doc_id", "text")))
    none = F.lit(2**63 - 1)
    part = F.struct("para", F.nullif("doc_kept", none).alias("kept"))
    lists = repeats.groupBy("doc", "tie").agg(
        F.sort_array(F.collect_list(F.when(F.col("passage") >= PASSAGE, part))).alias("r"),
        F.sort_array(F.collect_list(F.when(F.col("passage") < PASSAGE, F.col("para")))).alias("short"),
    )
    whole = members.where("para = -1").select("doc", "tie", F.col("words").cast("long").alias("n_paragraphs"))
    empty = F.array()
    return whole.join(lists, ["doc", "tie"], "left").select(
        F.nullif("doc", none).alias("doc_id"),
        "n_paragraphs",
        F.coalesce(F.size("r"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.col("r.para"), empty.cast("array<int>")).alias("removed"),
        F.coalesce(F.col("r.kept"), empty.cast("array<bigint>")).alias("kept_in"),
        F.coalesce(F.size("short"), F.lit(0)).cast("long").alias("n_short"),
        F.coalesce("short", empty.cast("array<int>")).alias("removed_short"),
    )


def _without(batches):
    for batch in batches:
        raw = texts_of(batch["text"])
        out = batch["text"].to_pylist()
        gone = [set(g or ()) for g in batch["gone"].to_pylist()]
        # What goes of each text: from a paragraph's first word to that of the next.
        cuts: dict[int, list[tuple[int, bool]]] = {t: [] for t, g in enumerate(gone) if g}
        for p in paragraphs(raw):
            for t, number, begin in zip(p.text.tolist(), p.number.tolist(), p.begin.tolist(), strict=True):
                if t in cuts:
                    cuts[t].append((begin, number in gone[t]))
        for t, parts in cuts.items():
            text = raw[t]
            kept = [text[: parts[0][0]]]
            for (begin, drop), end in zip(parts, [*(b for b, _ in parts[1:]), len(text)], strict=True):
                if not drop:
                    kept.append(text[begin:end])
            out[t] = b"".join(kept).decode()
        yield pa.record_batch([batch["row"], pa.array(out, pa.string())], names=["row", "left"])


def remove(docs: DataFrame, short: bool = False) -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts.

    With ``short`` also repeated paragraphs that make no passage.  White space behind a
    paragraph goes with it.
    """
    # The caller's row is one column, so no name of it can meet one of ours.
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    named = keyed(docs.select("doc_id", "text", F.struct(*columns).alias("row")))
    _, repeats = duplicates(named)
    if not short:
        repeats = repeats.where(F.col("passage") >= PASSAGE)
    gone = repeats.groupBy("doc", "tie").agg(F.collect_list("para").alias("gone"))
    rows = named.join(gone, ["doc", "tie"], "left").select("row", "text", "gone")
    kind = rows.schema["row"].dataType.simpleString()
    return arrow(rows, _without, f"row {kind}, left string").select(
        *(F.col("left").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns)
    )


_END = re.compile("(?<=[.!?])[ \t\n\x0b\x0c\r]+|[ \t\x0b\x0c\r]*\n[ \t\n\x0b\x0c\r]*")


def plain_paragraphs(text: str | None) -> list[str]:
    """The definition for texts without any of more than ``LONG`` words; for tests."""
    return [p for p in _END.split(text or "") if p.strip(" \t\n\x0b\x0c\r")]


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[list[int], list[int]]]:
    """Removed paragraphs of each document, in passages and others, by comparing all pairs
    that share a shingle; for tests."""
    items = []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        for i, part in enumerate(plain_paragraphs(text)):
            items.append((doc_id, i, plain_set(part), len(part.split())))
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    # Only pairs with a common shingle can be linked; equal sets are looked at once.
    first: dict[frozenset, int] = {}
    holders: dict[tuple, list[int]] = {}
    for i in range(len(items)):
        shingles = items[i][2]
        j = first.setdefault(frozenset(shingles), i)
        if j != i:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
            continue
        for j in {j for s in shingles for j in holders.get(s, ())}:
            a, b = find(i), find(j)
            if a != b and linked(shingles, items[j][2]):
                root[max(a, b)] = min(a, b)
        for s in shingles:
            holders.setdefault(s, []).append(i)
    out: dict[int, tuple[list[int], list[int]]] = {doc_id: ([], []) for doc_id, _ in rows}
    run: list[tuple[int, int, int]] = []
    for i, (doc_id, para, _, words) in [*enumerate(items), (-1, (None, 0, None, 0))]:
        goes = i >= 0 and find(i) != i
        if run and not (goes and doc_id == run[-1][0] and para == run[-1][1] + 1):
            kind = 0 if sum(w for *_, w in run) >= PASSAGE else 1
            for d, p, _ in run:
                out[d][kind].append(p)
            run = []
        if goes:
            run.append((doc_id, para, words))
    return out
