"""Join of documents by the Jaccard similarity of their word shingles, through a token-group matrix.

Similar sets are partitioned into groups of bounded number and like sizes, by the smallest shingle that they share with
others. The matrix says which groups hold which shingles: each group's union. A set can only reach the threshold with a
member of a group whose union holds enough of its shingles. So it visits the groups that hold enough of its rarest
shingles, its overlap with the whole union is bounded, and only qualifying groups are opened and compared member by
member. Each pair of groups is visited from one side.

Shingles are ordered by their frequency in a hashed sample of the documents, then by hash. Any one order gives all
links, so the sample only decides how few candidates there are. Equal sets are one node throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import WordHashes, map_rows, ngram_hashes, remember_only, stage
from .components import components

SHINGLE = 5
PERCENT = 80
#: One in so many documents is counted for the order of shingles.
ORDER_SAMPLE = 16
#: A shingle is frequent if it has this share of the sample, or four rows: so there are at most 1 / share.
FREQUENT_SHARE = 2e-6
MEMBERS = 64
#: Sizes of the sets in a group differ by this factor at most.
SIZE_BAND = 1.05
VISITORS = 256
#: Bytes of sets and their places that are sent to every executor at most; beyond it the texts are shuffled.
BROADCAST_BYTES = 1 << 26

_WORDS = WordHashes()


def shingle_set(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of all runs of ``words`` words, in order."""
    remember_only(_WORDS)
    return np.unique(ngram_hashes(_WORDS.of(text), words))


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit id of a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set of this size shares with any similar one."""
    return -(-size * percent // 100)


def frequent_shingles(docs: DataFrame, id_col: str, text_col: str, words: int, sample: int) -> dict[int, int]:
    """Counts of the frequent shingles in one of ``sample`` documents; they only order shingles."""

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        for (text,) in given:
            yield from ((h,) for h in shingle_set(text, words).view(np.int64).tolist())

    some = docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(sample)) == 0).select(F.col(text_col))
    counted = map_rows(some, "shingle long", rows, 1 << 16).groupBy("shingle").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    return dict(counted.where(F.col("n") >= max(4, total * FREQUENT_SHARE)).toLocalIterator())


def signatures(
    docs: DataFrame, frequent: dict[int, int], id_col: str, text_col: str, words: int, percent: int
) -> DataFrame:
    """Per document: ``key``, ``tid`` (hash of the text), ``set_id``, ``size`` and the rarest shingles, of which similar
    sets share one."""
    keys = np.array(sorted(frequent), np.int64)
    counts = np.array([frequent[k] for k in keys.tolist()], np.int64)
    held = docs.sparkSession.sparkContext.broadcast((keys, counts))
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        known, often = held.value
        for key, tid, text in given:
            shingles = shingle_set(text, words)
            size = len(shingles)
            if size == 0:
                yield key, tid, None, 0, []
                continue
            signed = shingles.view(np.int64)
            take = size - least_overlap(size, percent) + 1
            if len(known):
                at = np.minimum(np.searchsorted(known, signed), len(known) - 1)
                rank = np.where(known[at] == signed, often[at], 0)
                signed = signed[np.argsort(rank, kind="stable")]
            yield key, tid, set_id(shingles), size, signed[:take]

    return map_rows(
        docs.select(F.col(id_col), F.xxhash64(text_col).alias("tid"), F.col(text_col).alias("text")),
        f"key {kind}, tid long, set_id long, size int, rare array<long>",
        rows,
        512,
    )


def _overlaps(members: list[np.ndarray]):
    """The shingles of a group with their members, and a function that bounds and counts overlaps with them."""
    tokens = np.concatenate(members)
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]

    def overlap(shingles: np.ndarray, least: int) -> np.ndarray | None:
        low, high = np.searchsorted(tokens, shingles), np.searchsorted(tokens, shingles, "right")
        width = high - low
        if np.count_nonzero(width) < least:  # the union holds too few: the group stays closed
            return None
        ends = np.cumsum(width)
        places = np.arange(ends[-1]) + np.repeat(low - ends + width, width)
        return np.bincount(owner[places], minlength=len(members))

    return overlap


def _compare(rows: list[tuple], percent: int) -> Iterator[tuple[int, int, int]]:
    """(set, root, links) for each set with a link in a group; rows are (members first) role, set id, shingles."""
    ids = [r[1] for r in rows]
    sets = [np.frombuffer(r[2], np.uint64) for r in rows]
    inner = sum(r[0] < 2 for r in rows)
    whole = bool(rows) and rows[0][0] == 0  # members are compared with one another only once
    overlap = _overlaps(sets[:inner])
    sizes = np.array([len(s) for s in sets])
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(0 if whole else inner, len(rows)):
        both = overlap(sets[i], least_overlap(len(sets[i]), percent))
        if both is None:
            continue
        union = sizes[i] + sizes[:inner] - both
        near = np.flatnonzero(100 * both >= percent * union)
        for j in near[near > i] if i < inner else near:
            links[i] += 1
            links[j] += 1
            parent[find(int(j))] = find(i)
    lowest: dict[int, int] = {}
    for i in range(len(rows)):
        if links[i]:
            root = find(i)
            lowest[root] = min(lowest.get(root, ids[i]), ids[i])
    for i in range(len(rows)):
        if links[i]:
            yield ids[i], lowest[find(i)], links[i]


def _least_common(size: F.Column, other: F.Column, percent: int) -> F.Column:
    """Rare shingles that two similar sets of these sizes have in common.

    Of ``size - least_overlap + 1`` shingles in one order, sets with an overlap of ``o`` share at least as many as the
    shorter of these lists is longer than the shingles that its set does not share.
    """
    overlap = F.ceil((size + other) * percent / F.lit(100 + percent))
    return overlap + 1 - F.ceil(F.greatest(size, other) * percent / F.lit(100))


def _visits(shared: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Sets and the groups, their own or behind it, whose rare shingles cover enough of theirs for a similar member."""
    placed = shared.join(members.select("set_id", F.col("group").alias("home")), "set_id")
    matrix = placed.groupBy("shingle", F.col("home").alias("group")).agg(
        F.count("*").alias("holders"), F.min("size").alias("low"), F.max("size").alias("high")
    )
    ahead = (F.col("group") > F.col("home")) | ((F.col("group") == F.col("home")) & (F.col("holders") > 1))
    near = (100 * F.col("high") >= percent * F.col("size")) & (100 * F.col("size") >= percent * F.col("low"))
    met = placed.join(matrix, "shingle").where(ahead & near).groupBy("set_id", "size", "home", "group")
    met = met.agg(F.count("*").alias("common"), F.min("low").alias("low"), F.max("high").alias("high"))
    low = F.greatest(F.col("low"), F.ceil(F.col("size") * percent / F.lit(100)))
    high = F.least(F.col("high"), F.floor(F.col("size") * 100 / F.lit(percent)))
    least = F.least(*[_least_common(F.col("size"), other, percent) for other in (low, high)]) - 1  # rounding
    return met.where(F.col("common") >= least).select("set_id", "group", (F.col("group") == F.col("home")).alias("own"))


def similar_sets(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE,
    percent: int = PERCENT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (``key``, ``tid``, ``set_id``, ``size`` per document), links (``set_id``, ``root``, ``links`` per group) and their
    components (``node``, ``root``)."""
    frequent = frequent_shingles(docs, id_col, text_col, words, ORDER_SAMPLE)
    signed = stage(signatures(docs, frequent, id_col, text_col, words, percent), folder, "signatures")
    # repeated rows stay in: they only make some shingles look shared
    first = signed.where("size > 0").groupBy("set_id").agg(F.min("key").alias("key"))
    rare = signed.join(first, ["set_id", "key"]).select("set_id", "size", F.explode("rare").alias("shingle"))
    often = rare.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    shared = stage(rare.join(often, "shingle"), folder, "shared")
    home = shared.groupBy("set_id").agg(F.min("shingle").alias("home"), F.max("size").alias("size"))
    home = home.withColumn("band", F.floor(F.log("size") / math.log(SIZE_BAND)).cast("int"))
    full = home.groupBy("home", "band").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("set_id"), F.col("parts"))
    members = home.join(full, ["home", "band"]).select("set_id", F.xxhash64("home", "band", part).alias("group"))
    members = stage(members, folder, "members")
    visits = stage(_visits(shared, members, percent), folder, "visits")

    rooms = F.ceil(F.col("guests") / F.lit(VISITORS)).cast("long")
    guests = visits.where("not own").groupBy("group").agg(F.count("*").alias("guests")).withColumn("rooms", rooms)
    coming = visits.where("not own").join(guests, "group").select(
        "set_id", "group", F.pmod(F.xxhash64("set_id", F.lit(3)), F.col("rooms")).alias("room"), F.lit(2).alias("role")
    )
    seats = visits.where("own").select("set_id", "group", F.lit(1).cast("long").alias("rooms"))
    seats = seats.unionByName(members.join(guests, "group").select("set_id", "group", "rooms"))
    seats = seats.groupBy("set_id", "group").agg(F.max("rooms").alias("rooms"))
    hosts = seats.select(
        "set_id", "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rooms") - 1)).alias("room")
    ).withColumn("role", F.when(F.col("room") == 0, 0).otherwise(1))
    places = stage(hosts.unionByName(coming), folder, "places")

    def sets(given: Iterator[tuple]) -> Iterator[tuple]:
        for set_key, seats_of, text in given:
            shingles = shingle_set(text, words)
            if set_id(shingles) == set_key:
                for seat in seats_of:
                    yield seat["group"], seat["room"], seat["role"], set_key, shingles.tobytes()

    wanted = places.groupBy("set_id").agg(F.collect_list(F.struct("group", "room", "role")).alias("seats"))
    wanted = stage(wanted.join(first, "set_id"), folder, "wanted")
    named = wanted.select("set_id", "seats", F.col("key").alias("wanted"))
    if (wanted.agg(F.sum(F.size("seats") * 32 + F.octet_length(F.col("key").cast("string")) + 64)).first()[0] or 0) <= BROADCAST_BYTES:
        named = F.broadcast(named)
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(named, F.col("k") == F.col("wanted"))
    met = map_rows(
        texts.select("set_id", "seats", "t"), "group long, room long, role int, set_id long, shingles binary", sets, 256
    )
    met = met.repartition("group", "room").sortWithinPartitions("group", "room", "role", "set_id")

    def compare(given: Iterator[tuple]) -> Iterator[tuple]:
        for _, rows in groupby(given, key=lambda r: r[:2]):
            rows = [next(same)[2:] for _, same in groupby(rows, key=lambda r: r[2:4])]  # repeated rows once
            if len(rows) > 1:
                yield from _compare(rows, percent)

    links = stage(map_rows(met, "set_id long, root long, links long", compare), folder, "links")
    return signed.select("key", "tid", "set_id", "size"), links, components(links, folder, "set_id", "root")


def similarity_classes(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Per document ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``n_links``.

    ``n_links`` counts the linked other sets. Empty and null texts have no shingles and are their own component; so is
    a text without a link. Repeated rows are one node. Null ids are the smallest of no component but their own.
    """
    nodes, links, roots = similar_sets(docs, folder, id_col, text_col, words, percent)
    degree = links.groupBy(F.col("set_id").alias("s")).agg(F.sum("links").alias("n_links"))
    rooted = nodes.join(roots, F.col("set_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set_id"))
    lowest = rooted.where("root is not null").groupBy(F.col("root").alias("r")).agg(F.min("key").alias("component_id"))
    out = rooted.join(lowest, F.col("root") == F.col("r"), "left").join(degree, F.col("set_id") == F.col("s"), "left")
    return out.select(
        F.col("key").alias(id_col),
        F.col("size").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "key").alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def representatives(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``key``, ``tid`` (``xxhash64`` of the text) and ``rows`` of the document that stands for each component.

    It is the one with the smallest id, then hash of its text; a null id is the smallest. Each text of an id is judged by
    its own component, rows without words stay, and ``rows`` says how often a row occurs as it is.
    """
    nodes, _, roots = similar_sets(docs, folder, id_col, text_col, **options)
    rows = nodes.groupBy("key", "tid", "set_id").agg(F.count("*").alias("rows"))
    rooted = rows.join(roots, F.col("set_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set_id"))
    first = rooted.where("root is not null").groupBy("root").agg(F.min(F.struct("key", "tid", "rows")).alias("first"))
    return first.select("first.*").unionByName(rows.where("set_id is null").select("key", "tid", "rows"))
