"""Jaccard similarity join on five-word shingles with adaptive multi-match prefixes.

Documents with one shingle set are one *class*; all work is on classes, so copies
cost one row.  Shingles have a global order: rare ones by hash, then the frequent
ones by their count.  If two sets have similarity T, any l of at least T*n of their
tokens are shared, and so at least l of the first n - ceil(T*n) + l tokens of either
(its l-prefix) are.  Every class picks the l that promises least work, from the
counts of the tokens in its prefix; a pair needs min(l) shared prefix tokens, and
the room left behind them, before its sets are compared.

Groups of thousands of near copies must not make all pairs.  Token lists are first
linked in stars: in each of a few rounds every set is compared with one other, the star
of another component that it shares most tokens with.  Verified links give components,
and in the last step only pairs across components of a list are candidates; pairs inside
cannot change them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.llm.common import arrow, mix, signed, text_key, texts_of
from tidemark.llm.graph import components
from tidemark.llm.shingles import plain_set, linked, set_hash, shingle_sets
from tidemark.session import pin

#: A token in more than one in FREQUENT of all (document, token) pairs goes to the
#: end of the order, so there are at most FREQUENT such tokens: 16 bytes each.
FREQUENT = 1_000_000
LONGEST = 8
#: Rounds that link each set with one star, before all pairs across components.
STAR_ROUNDS = 1
_FLUSH = 2_000_000
#: Classes a task remembers.
_SEEN = 1 << 18
_MANY = (1 << 31) - 1
#: Parities kept of a set.
_BITS = 512
#: Rows of the bitmap that says which texts are asked for: at most some 16 MB for each task's machine.
SIFT = 1 << 18

_U = np.uint64


def _profile(batches):
    """Rows of documents, and the tokens that several documents of a task share."""

    def counts(gathered):
        tokens, count = np.unique(np.concatenate(gathered), return_counts=True)
        often = count >= 3
        return signed(tokens[often]), count[often]

    def out(doc_id, key, cls, n, bits, token, count):
        size = max(len(doc_id), len(token))

        def column(values, kind):
            values = list(values)
            return pa.array(values + [None] * (size - len(values)), kind)

        return pa.record_batch(
            [column(doc_id, pa.int64()), column(key, pa.int64()), column(cls, pa.int64()),
             column(n, pa.int64()), column(bits, pa.list_(pa.int64())),
             column(token, pa.int64()), column(count, pa.int64())],
            names=["doc_id", "key", "cls", "n", "bits", "token", "count"],
        )

    gathered, size = [], 0
    for batch in batches:
        cls, n, bits = [], [], []
        for tokens in shingle_sets(texts_of(batch["text"])):
            cls.append(set_hash(tokens) if len(tokens) else None)
            n.append(len(tokens))
            bits.append(_bits(tokens) if len(tokens) else None)
            gathered.append(tokens)
            size += len(tokens)
            if size >= _FLUSH:
                yield out([], [], [], [], [], *counts(gathered))
                gathered, size = [], 0
        yield out(batch["doc_id"].to_pylist(), batch["key"].to_pylist(), cls, n, bits, [], [])
    if size:
        yield out([], [], [], [], [], *counts(gathered))


def _prefix(tokens: np.ndarray, frequent: np.ndarray, weight: np.ndarray):
    """(tokens in global order, need, end): the cheapest l-prefix of a set."""
    n = len(tokens)
    at = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
    rank = np.zeros(n, np.int64)
    if len(frequent):
        known = frequent[at] == tokens
        rank[known] = weight[at[known]]
        if known.any():
            # Sets come sorted, and ties of the count stay so.
            order = np.argsort(rank, kind="stable")
            tokens, rank = tokens[order], rank[order]
    first = n - (4 * n + 4) // 5 + 1
    longest = min(LONGEST, (4 * n + 4) // 5)
    reach = np.cumsum(np.maximum(rank[: first + longest - 1], 1))[first - 1 :]
    need = np.arange(1, longest + 1)
    # Rows to move and list entries to meet, which l matches thin out.
    cost = first + need + reach / need
    need = int(need[np.argmin(cost)])
    last = first + need - 2
    # Where the prefix ends in the global order; equal numbers say nothing.
    many = min(int(rank[last]), _MANY)
    end = many << 32 | (int(tokens[last]) >> 32 if many < _MANY else 0)
    return tokens[: last + 1], need, end


def _index(frequent: np.ndarray, weight: np.ndarray):
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            parts = []
            for tokens in shingle_sets(texts_of(batch["text"])):
                if not len(tokens):
                    continue
                cls = set_hash(tokens)
                if cls in seen:
                    continue
                if len(seen) < _SEEN:  # only saves rows: repeated ones are merged later
                    seen.add(cls)
                prefix, need, end = _prefix(tokens, frequent, weight)
                k = len(prefix)
                parts.append((signed(prefix), np.full(k, cls), np.full(k, end),
                              np.full(k, len(tokens)), np.arange(k), np.full(k, need)))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                yield pa.record_batch(
                    [pa.array(c) for c in columns[:3]]
                    + [pa.array(c.astype(np.int32)) for c in columns[3:]],
                    names=["token", "cls", "end", "n", "pos", "need"],
                )

    return run


def _bits(tokens: np.ndarray) -> list[int]:
    """Parities of a set's tokens by a hash: two sets differ in no more bits than tokens."""
    odd = np.bincount((mix(tokens) & _U(_BITS - 1)).astype(np.int64), minlength=_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _sets(batches):
    for batch in batches:
        found = [s for s in shingle_sets(texts_of(batch["text"])) if len(s)]
        yield pa.record_batch(
            [pa.array([set_hash(s) for s in found], pa.int64()),
             pa.array([s.tobytes() for s in found], pa.binary())],
            names=["cls", "tokens"],
        )


def _compare(batches):
    for batch in batches:
        good = []
        for a, b in zip(batch["ta"].to_pylist(), batch["tb"].to_pylist(), strict=True):
            x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
            small, large = (x, y) if len(x) < len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            good.append(100 * both >= 80 * (len(x) + len(y) - both))
        keep = pa.array(good, pa.bool_())
        yield pa.record_batch([batch["a"].filter(keep), batch["b"].filter(keep)], names=["a", "b"])


def _possible(n: Column, m: Column, shared: Column, last_n: Column, last_m: Column) -> Column:
    """Whether sets of n and m tokens can be similar, with so many shared up to these places."""
    room = F.least(n - last_n, m - last_m) - 1
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * (shared + room) >= 4 * (n + m))


def _promising(met: DataFrame, of_token: WindowSpec) -> DataFrame:
    """Lists of the sets that can have a partner, each with ``room``.

    ``room`` is a set's size less the prefix tokens that no other set has in its prefix.
    A set is out that shares fewer tokens than it and any partner need, and so are
    lists it leaves with one member.
    """
    own = met.groupBy("cls").agg(
        F.count("*").alias("shared"), F.first("n").alias("__n"), F.first("need").alias("__need"),
        F.min("least_need").alias("__least"),
    )
    able = own.where("shared >= __least").select("cls", _room("__n", "__need").alias("room"))
    return (
        met.drop("least_need").join(able, "cls")
        .withColumn("size", F.count("*").over(of_token))
        .where("size > 1").drop("size")
    )


def _room(n: str, need: str) -> Column:
    """Tokens of a set that may be shared, if of its prefix only ``shared`` ones may."""
    size = F.col(n).cast("long")
    length = F.least(size, size - F.call_function("div", 4 * size + 4, F.lit(5)) + F.col(need))
    return size - length + F.col("shared")


def _room_for_both(n: str, room: str, end: str, m: str, other: str, other_end: str) -> Column:
    """Whether sets of n and m tokens can be similar, by what is left of one of them.

    Of two prefixes the one that ends first lies whole in the other's part of the
    order: its tokens that are nowhere else are not in the other set either.
    """
    most = (
        F.when(F.col(end) < F.col(other_end), F.col(room))
        .when(F.col(other_end) < F.col(end), F.col(other))
        .otherwise(F.greatest(room, other))
    )
    return 9 * most >= 4 * (F.col(n) + F.col(m))


def _maybe_in(rows: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """Rows whose ``name`` may be one of ``wanted``, by a bitmap; an exact join has to follow.

    The bitmap has one row for each 64 places, at most ``SIFT``, however many are wanted.
    """
    place = F.pmod(F.xxhash64(name), F.lit(64 * SIFT))
    bit = F.lit(1).cast("long")
    words = (
        wanted.select(place.alias("place"))
        .select(F.floor(F.col("place") / 64).cast("int").alias("__slot"),
                F.call_function("shiftleft", bit, (F.col("place") % 64).cast("int")).alias("one"))
        .groupBy("__slot").agg(F.bit_or("one").alias("__word"))
    )
    here = rows.withColumn("__place", place)
    met = here.join(F.broadcast(words), F.floor(F.col("__place") / 64).cast("int") == F.col("__slot"))
    at = (F.col("__place") % 64).cast("int")
    return met.where(F.call_function("shiftrightunsigned", "__word", at).bitwiseAND(bit) == 1).select(*rows.columns)


def _sets_of(classes: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """(cls, tokens): the whole sets of some classes, written once for a comparison."""
    # One document of each class, found again by id and text hash.
    names = ["no_id", "id", "key"]
    no_id, own_id = F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id")
    wanted = pin(
        members.where("cls is not null").groupBy("cls")
        .agg(F.min(F.struct(no_id, own_id, "key")).alias("d"))
        .join(classes, "cls", "left_semi").select("d.*"),
        "wanted",
    )
    # Texts that nobody asks for stay where they are.
    texts = _maybe_in(docs.select(no_id, own_id, text_key().alias("key"), "text"), wanted, "key")
    # Repeated rows meet in the partition that the join has made.
    found = texts.join(wanted.hint("merge"), names).groupBy(*names).agg(F.first("text").alias("text"))
    return pin(arrow(found.select("text"), _sets, "cls long, tokens binary"), "sets")


def _verified(pairs: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are similar; only sets of a pair are made."""
    sides = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls")))
    sets = _sets_of(sides.distinct(), members, docs)
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.hint("merge").join(left, "a").join(right.hint("merge"), "b")
    return pin(arrow(both.select("a", "b", "ta", "tb"), _compare, "a long, b long"), "links")


def _with_roots(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Lists with the component of each member, those of one component left out."""
    of_token = Window.partitionBy("token")
    # Both sides grow with the corpus: always by a shuffle, never by sending one to all.
    known = lists.join(roots.hint("merge"), F.col("cls") == F.col("node"), "left").drop("node")
    return (
        known.withColumn("root", F.coalesce("root", "cls"))
        .select("*", F.min("root").over(of_token).alias("low"),
                F.max("root").over(of_token).alias("high"))
        .where("low <> high").drop("high")
    )


def _star_pairs(mixed: DataFrame, tried: DataFrame) -> DataFrame:
    """(a, b): each set with the star, of another component, that it shares most tokens with.

    The star of a list is the member with the fewest tokens of its own, as an original
    has among its edited copies; members of its component take the best of the others.
    """
    of_token = Window.partitionBy("token")
    member = F.struct((F.col("n") - F.col("room")).alias("own"), "cls", "root", "n", "pos", "room", "end")
    best = mixed.withColumn("star", F.min(member).over(of_token))
    other = F.min(F.when(F.col("root") != F.col("star.root"), member)).over(of_token)
    with_star = best.withColumn("other", other).withColumn(
        "star", F.when(F.col("root") != F.col("star.root"), F.col("star")).otherwise(F.col("other"))
    )
    shared = (
        with_star.where(_room_for_both("n", "room", "end", "star.n", "star.room", "star.end"))
        .groupBy("cls", F.col("star.cls").alias("with"))
        .agg(
            F.count("*").alias("shared"), F.first("n").alias("n"), F.max("pos").alias("pos"),
            F.first("star.n").alias("m"), F.max("star.pos").alias("last"),
        )
        .where(_possible(*map(F.col, ("n", "m", "shared", "pos", "last"))))
        .select(F.least("cls", "with").alias("a"), F.greatest("cls", "with").alias("b"), "cls", "shared")
        .join(tried, ["a", "b"], "left_anti")
    )
    chosen = shared.groupBy("cls").agg(F.max_by(F.struct("a", "b"), F.struct("shared", "a", "b")).alias("p"))
    return chosen.select("p.a", "p.b").distinct()


def _most_needed(n: str, m: str, own: str, length: str) -> Column:
    """Shared tokens that similar sets of n and m tokens have in the prefix that ends first.

    ``own`` and ``length`` are of that prefix's set: what is not in it is behind it.
    """
    overlap = F.call_function("div", 4 * (F.col(n) + F.col(m)) + 8, F.lit(9))
    return overlap - (F.col(own) - F.col(length))


def _few_bits_differ(x: str, y: str, n: str, m: str) -> Column:
    """Whether sets of n and m tokens can be similar, by the parities of their tokens.

    Similar sets differ in at most (n + m) / 9 tokens, and in no more bits than tokens.
    """
    differ = sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(_BITS // 64)), F.lit(0))
    return 9 * differ <= F.col(n) + F.col(m)


def _pairs_across(mixed: DataFrame, bits: DataFrame) -> DataFrame:
    """(a, b): all pairs across components of a list that meet what similar sets must.

    ``bits`` has the parities of each class.  Of q shared tokens the first one has q - 1 behind it in either set, so it is among
    the first u - q + 1 of the u tokens that a set has in these lists: its rarest ones,
    and only they look for partners.
    """
    place = F.struct("pos", "token", "low")
    # What a set has in lists of its own component is in no set of another one, so
    # room is counted anew.
    sets = mixed.groupBy("cls").agg(
        *(F.first(c).alias(c) for c in ("n", "need", "end", "root")),
        F.sort_array(F.collect_list(place)).alias("places"), F.count("*").alias("shared"),
    )
    sets = pin(
        sets.withColumn("room", _room("n", "need"))
        .withColumn("length", F.col("n") - F.col("room") + F.col("shared"))
        .join(bits.hint("merge"), "cls"),
        "prefixes",
    )
    columns = ("cls", "n", "room", "end", "root", "length", "shared", "bits")
    rows = sets.select(*columns, F.posexplode("places").alias("at", "place")).select(
        *columns, "at", F.col("place.token").alias("token"), F.col("place.low").alias("low")
    )

    def side(name: str, df: DataFrame, *more: str) -> DataFrame:
        return df.select("token", *more, *(F.col(c).alias(f"{name}_{c}") for c in (*columns, "at")))

    def probes(e: str, o: str) -> Column:
        needed = _most_needed("x_n", "y_n", f"{e}_n", f"{e}_length")
        first = [F.col(f"{s}_at") <= F.col(f"{s}_shared") - needed for s in (e, o)]
        return (F.col(f"{e}_end") <= F.col(f"{o}_end")) & first[0] & first[1]

    # The least component of a list may be huge: it only meets the others.
    pairs = (
        side("x", rows.where("root <> low")).join(side("y", rows, "low"), "token")
        .where("x_root <> y_root and (y_root = low or x_cls < y_cls)")
        .where(5 * F.least("x_n", "y_n") >= 4 * F.greatest("x_n", "y_n"))
        .where(_room_for_both("x_n", "x_room", "x_end", "y_n", "y_room", "y_end"))
        .where(_few_bits_differ("x_bits", "y_bits", "x_n", "y_n"))
        .where(probes("x", "y") | probes("y", "x"))
        .select(F.least("x_cls", "y_cls").alias("a"), F.greatest("x_cls", "y_cls").alias("b"))
        .distinct()
    )

    def prefix(name: str) -> DataFrame:
        kept = ("n", "need", "end", "length")
        return sets.select(
            F.col("cls").alias(name), F.col("places.token").alias(f"{name}_tokens"),
            *(F.col(c).alias(f"{name}_{c}") for c in kept),
        )

    both = pairs.hint("merge").join(prefix("a"), "a").join(prefix("b").hint("merge"), "b")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    least = F.when(F.col("a_end") < F.col("b_end"), _most_needed("a_n", "b_n", "a_n", "a_length"))
    least = least.when(
        F.col("b_end") < F.col("a_end"), _most_needed("a_n", "b_n", "b_n", "b_length")
    ).otherwise(0)
    return both.where((shared >= F.least("a_need", "b_need")) & (shared >= least)).select("a", "b")


def _profiled(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text").withColumn("key", text_key())
    return pin(
        arrow(rows, _profile, "doc_id long, key long, cls long, n long, bits array<long>, token long, count long"),
        "profile",
    )


def _frequent(profile: DataFrame, members: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens for the end of the order, sorted, with their counts: at most 2 * FREQUENT."""
    total = members.agg(F.sum("n")).first()[0] or 0
    often = (
        profile.where("token is not null").groupBy("token").agg(F.sum("count").alias("count"))
        # Tasks leave out their rare ones, hence the half.
        .where(F.col("count") >= max(8, total // (2 * FREQUENT)))
    )
    rows = often.toArrow()
    token = rows["token"].to_numpy().astype(np.int64).view(_U)
    order = np.argsort(token)
    return token[order], rows["count"].to_numpy()[order]


def similar_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, roots): documents with their class, and the component of linked classes.

    members: doc_id, key (hash of the text), cls (NULL without words), n.
    roots: node, root, for the classes that have a link.
    """
    profile = _profiled(docs)
    members = profile.where("token is null").select("doc_id", "key", "cls", "n")
    frequent, weight = _frequent(profile, members)
    rows = arrow(
        docs.select("text"), _index(frequent, weight),
        "token long, cls long, end long, n int, pos int, need int",
    )
    of_token = Window.partitionBy("token")
    met = pin(
        rows.repartition("token").dropDuplicates(["token", "cls"])
        .select("*", F.count("*").over(of_token).alias("size"),
                F.min("need").over(of_token).alias("least_need"))
        .where("size > 1").drop("size"),
        "met",
    )
    lists = pin(_promising(met, of_token), "lists")
    # One class, one set: its parities stand with each of its documents.
    bits = (
        profile.where("cls is not null").select("cls", "bits")
        .join(lists.select("cls").distinct().hint("merge"), "cls", "left_semi")
        .groupBy("cls").agg(F.first("bits").alias("bits"))
    )
    spark = docs.sparkSession
    roots = spark.createDataFrame([], "node long, root long")
    tried = spark.createDataFrame([], "a long, b long")
    for _ in range(STAR_ROUNDS):
        pairs = pin(_star_pairs(_with_roots(lists, roots), tried), "pairs")
        found = _verified(pairs, members, docs)
        if found.isEmpty():
            break
        roots = components(_edges(roots).unionByName(found))
        tried = tried.unionByName(pairs)
    mixed = pin(_with_roots(lists, roots), "mixed")
    across = _pairs_across(mixed, bits).join(tried, ["a", "b"], "left_anti")
    found = _verified(pin(across, "pairs"), members, docs)
    return members, components(_edges(roots).unionByName(found))


def _edges(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("root").alias("a"), F.col("node").alias("b"))


def _with_component(docs: DataFrame) -> DataFrame:
    """Members with ``comp``, which is the same for all documents linked with each other."""
    members, roots = similar_components(docs)
    return members.join(roots, F.col("cls") == F.col("node"), "left").select(
        "doc_id", "key", "n", F.coalesce("root", "cls").alias("comp")
    )


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    NULL texts are empty; without words a document is linked with nothing.  A NULL
    doc_id takes part, but is the component_id only of documents without any id.
    """
    rows = pin(_with_component(docs), "members")
    least = rows.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "comp", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        .alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Whole rows: of each component the document with the smallest id (NULL ids last).

    Documents without words stay.  Rows equal in id and text stay together.
    """
    rows = pin(_with_component(docs), "members")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    best = rows.where("comp is not null").groupBy("comp").agg(F.min(rank).alias("best"))
    gone = pin(
        rows.join(best, "comp").where(rank != F.col("best"))
        .select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct(),
        "gone",
    )
    # The caller's row is one column, so no name of it can meet one of ours.
    whole = docs.select("doc_id", text_key().alias("__text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return whole.join(
        gone,
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__key")),
        "left_anti",
    ).select("row.*")


def brute_force(rows: list[tuple[int, str | None]]) -> list[tuple[int, int, int]]:
    """The definition, pair by pair; for tests."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
