"""Removal of long repeats by a logarithmic family of suffix arrays.

A repeat is a string of ``span`` bytes that starts at two or more places of the corpus. Each start belongs to the
smallest hash of a short byte gram in its string, so equal strings have one anchor, and starts with one anchor form
segments of a text. Only segments whose anchor occurs twice can hold repeats. They are partitioned by anchor, and each
partition keeps an index family: a batch of new segments is put in suffix order (its starts, ``span`` bytes deep), is
merge-scanned for equal strings with the segments of every level that share its anchors, in parts of bounded size, and
becomes a level; levels of one size merge. A scan ranks only segments in which a hash of the span occurs twice.
Equal segments are indexed once, with their number.

An anchor whose distinct segments are still many after a split (a passage in many texts, between different words) is not
indexed: its strings are counted start by start, by a 128-bit hash, with partial sums in each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import MEMO, map_rows, mixed, slices, stage

SPAN = 400
GRAM = 32
#: Starts of a text that are looked at together, and in one segment at most.
PIECE, SEGMENT = 1 << 20, 2048
#: An anchor with more places than this is split by a second anchor.
HOT_PLACES = 4096
#: Bytes of segments in a partition on average, and in a batch.
PARTITION_BYTES, BATCH_BYTES = 1 << 23, 1 << 20
#: Bytes of distinct segments of an anchor above which its starts are counted one by one.
GROUP_BYTES = 1 << 20

_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gram_hashes(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``GRAM`` bytes."""
    hashes = data.astype(np.uint64) + np.uint64(1 + seed)
    for i, factor in enumerate(_FACTORS):
        hashes = hashes[: -(1 << i)] * factor + hashes[1 << i :]
    return mixed(hashes)


def span_hashes(data: np.ndarray, span: int) -> np.ndarray:
    """Hashes of all runs of ``span`` bytes."""
    hashes, done = data.astype(np.uint64) + np.uint64(1), 1
    while 2 * done <= span:
        hashes = mixed(hashes[:-done] * _FACTORS[0] + hashes[done:])
        done *= 2
    return hashes[: len(hashes) - (span - done)] * _FACTORS[1] + hashes[span - done :]


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        hashes = np.minimum(hashes[:-done], hashes[done:])
        done *= 2
    return np.minimum(hashes[: len(hashes) - (width - done)], hashes[width - done :]) if width > done else hashes


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of equal values, cut to ``SEGMENT``."""
    firsts = np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1))
    lasts = np.concatenate((firsts[1:] - 1, [len(values) - 1]))
    long = np.flatnonzero(lasts - firsts >= SEGMENT)
    if len(long):
        more = np.concatenate([np.arange(firsts[i] + SEGMENT, lasts[i] + 1, SEGMENT) for i in long])
        firsts = np.union1d(firsts, more)
        lasts = np.concatenate((firsts[1:] - 1, [len(values) - 1]))
    return firsts, lasts


def anchored(data: bytes, span: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, first start, last start, places of the anchor) over the starts of a text."""
    starts = len(data) - span + 1
    width = span - GRAM + 1
    for at in range(0, starts, PIECE):
        size = min(PIECE, starts - at)
        hashes = gram_hashes(np.frombuffer(data, np.uint8, size + span - 1, at))
        minima = window_minima(hashes, width)
        signed = minima.view(np.int64)
        for first, last in zip(*(x.tolist() for x in _runs(minima))):
            places = int(np.count_nonzero(hashes[first : last + width] == minima[first]))
            yield int(signed[first]), at + first, at + last, places


def split_hot(data: bytes, anchor: int, first: int, last: int, span: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, first, last) of a segment, split by a second anchor."""
    hashes = gram_hashes(np.frombuffer(data, np.uint8, last - first + span, first), 7)
    minima = window_minima(hashes, span - GRAM + 1)
    both = mixed(minima ^ np.uint64(anchor % (1 << 64))).view(np.int64)
    for a, b in zip(*(x.tolist() for x in _runs(minima))):
        yield int(both[a]), first + a, first + b


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of tuples of ranks."""
    out = keys[0].astype(np.int64)
    for key in keys[1:]:
        size = int(key.max()) + 1 if len(key) else 1
        if (int(out.max()) + 1 if len(out) else 1) * size >= 1 << 62:
            out = np.unique(out, return_inverse=True)[1].astype(np.int64)
        out = out * size + key
    return np.unique(out, return_inverse=True)[1].astype(np.int64)


def span_ranks(text: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """Ranks of the strings of ``span`` bytes at ``starts``: equal strings, and only they, have equal ranks.

    Ranks of 8 bytes are combined to those of 24, 72 and so on, then two that overlap to the whole span.
    """
    size = len(text)
    padded = np.concatenate((text, np.zeros(3 * span, np.uint8))).astype(np.uint64)
    have = min(8, span)
    first = np.zeros(size + 2 * span, np.uint64)
    for i in range(have):
        first = (first << np.uint64(8)) | padded[i : i + len(first)]
    ranks = np.unique(first, return_inverse=True)[1].astype(np.int64)
    while 3 * have <= span:
        ranks = _dense(ranks[: -2 * have], ranks[have:-have], ranks[2 * have :])
        have *= 3
    while 2 * have <= span:
        ranks = _dense(ranks[:-have], ranks[have:])
        have *= 2
    return _dense(ranks[starts], ranks[starts + span - have])


class Level:
    """Segments with their anchors, and which of their starts repeat."""

    def __init__(self, ids: list[bytes], anchors: np.ndarray, bodies: list[bytes], whole: np.ndarray, span: int):
        self.ids, self.anchors, self.bodies, self.span, self.size = ids, anchors, bodies, span, 1
        self.starts = np.array([len(b) - span + 1 for b in bodies], np.int64)
        self.ends = np.cumsum(self.starts)
        self.repeats = np.repeat(whole, self.starts)

    def places(self, segments: np.ndarray) -> np.ndarray:
        """Places of the starts of some segments."""
        counts = self.starts[segments]
        ends = np.cumsum(counts)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.ends[segments] - ends, counts)

    def parts(self, segments: np.ndarray, size: int) -> Iterator[np.ndarray]:
        """Some segments in parts of about ``size`` bytes."""
        sizes = np.cumsum(self.starts[segments] + self.span)
        for part in np.split(segments, np.searchsorted(sizes, np.arange(size, sizes[-1] if len(sizes) else 0, size))):
            if len(part):
                yield part


def _starts(levels: list[Level], chosen: list[np.ndarray], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text of segments, their starts in it, starts of each, and the anchor number of each start."""
    bodies = [level.bodies[i] for level, segments in zip(levels, chosen) for i in segments.tolist()]
    text = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    counts = sizes - span + 1
    ends = np.cumsum(counts)
    starts = np.arange(ends[-1]) + np.repeat(np.cumsum(sizes) - sizes - ends + counts, counts)
    anchors = np.concatenate([level.anchors[segments] for level, segments in zip(levels, chosen)])
    return text, starts, counts, np.repeat(np.unique(anchors, return_inverse=True)[1], counts)


def _may_repeat(text: np.ndarray, starts: np.ndarray, anchors: np.ndarray, span: int) -> np.ndarray:
    """Starts whose string has the hash of another one's: all repeats are among them."""
    hashes = mixed(span_hashes(text, span)[starts] + mixed(anchors.astype(np.uint64)))
    order = np.sort(hashes)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(starts), bool)
    return twice[np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)] == hashes


def scan(levels: list[Level], chosen: list[np.ndarray], span: int) -> None:
    """Put the starts of some segments of some levels in suffix order, and mark those whose string occurs twice.

    Segments in which no start can repeat are left out of the suffix array.
    """
    if not sum(map(len, chosen)):
        return
    text, starts, counts, anchors = _starts(levels, chosen, span)
    may = np.logical_or.reduceat(_may_repeat(text, starts, anchors, span), np.cumsum(counts) - counts)
    edges = np.cumsum([0, *map(len, chosen)])
    chosen = [segments[may[a:b]] for segments, a, b in zip(chosen, edges, edges[1:])]
    if not may.any():
        return
    text, starts, counts, anchors = _starts(levels, chosen, span)
    ranks = _dense(anchors, span_ranks(text, starts, span))
    twice = np.bincount(ranks)[ranks] > 1
    at = 0
    for level, segments in zip(levels, chosen):
        places = level.places(segments)
        level.repeats[places] |= twice[at : at + len(places)]
        at += len(places)


def merge(a: Level, b: Level) -> Level:
    """One level over two that have been scanned with each other."""
    ids = a.ids + b.ids
    both = Level(ids, np.concatenate((a.anchors, b.anchors)), a.bodies + b.bodies, np.zeros(len(ids), bool), a.span)
    both.repeats = np.concatenate((a.repeats, b.repeats))
    both.size = a.size + b.size
    return both


class IndexFamily:
    """Levels of growing size; new batches are scanned against all of them."""

    def __init__(self, span: int):
        self.span = span
        self.levels: list[Level] = []

    def add(self, ids: list[bytes], anchors: list[int], bodies: list[bytes], whole: list[bool]) -> None:
        """A batch of distinct segments; ``whole`` marks those that occur twice as they are."""
        new = Level(ids, np.array(anchors, np.int64), bodies, np.array(whole, bool), self.span)
        scan([new], [np.arange(len(ids))], self.span)
        for level in self.levels:
            shared = np.intersect1d(level.anchors, new.anchors)
            mine = np.flatnonzero(np.isin(new.anchors, shared))
            for part in level.parts(np.flatnonzero(np.isin(level.anchors, shared)), BATCH_BYTES):
                scan([level, new], [part, mine[np.isin(new.anchors[mine], level.anchors[part])]], self.span)
        self.levels.append(new)
        while len(self.levels) > 1 and self.levels[-1].size == self.levels[-2].size:
            last = self.levels.pop()
            self.levels.append(merge(self.levels.pop(), last))

    def repeats(self) -> Iterator[tuple[bytes, list[int]]]:
        """Segment ids with the first and last repeated start of each run, as one flat list."""
        for level in self.levels:
            for i, name in enumerate(level.ids):
                flags = level.repeats[level.ends[i] - level.starts[i] : level.ends[i]]
                if flags.any():
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
                    yield name, (edges - np.arange(len(edges)) % 2).tolist()


def _single_starts(bodies: DataFrame, counts: DataFrame, folder: str, span: int) -> DataFrame:
    """``segment`` and ``runs`` of repeated starts, from counts of every string of ``span`` bytes.

    A segment that several tasks sent is taken once. No task holds a group: strings are summed where they lie, then by hash.
    """
    one = bodies.groupBy(F.col("name").alias("segment")).agg(F.first("body").alias("body"))
    one = one.join(counts.select("name", "n"), F.col("segment") == F.col("name")).select("segment", "body", "n")

    def strings(given: Iterator[tuple]) -> Iterator[tuple]:
        for name, body, n in given:
            body = bytes(body)
            for at in range(len(body) - span + 1):
                yield name, at, xxhash.xxh3_128_digest(body[at : at + span]), n

    starts = stage(map_rows(one, "segment binary, at int, string binary, n long", strings), folder, "starts")
    twice = starts.groupBy(F.col("string").alias("s")).agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("s")
    twice = stage(twice, folder, "twice")  # written, so that Spark can split the starts of a common string in the join
    found = starts.join(twice, F.col("string") == F.col("s")).groupBy("segment").agg(F.collect_list("at").alias("at"))

    def runs(given: Iterator[tuple]) -> Iterator[tuple]:
        for name, places in given:
            at = np.sort(np.array(places))
            cuts = np.flatnonzero(np.diff(at) > 1)
            yield name, np.column_stack((at[np.r_[0, cuts + 1]], at[np.r_[cuts, len(at) - 1]])).ravel().tolist()

    return map_rows(found, "segment binary, runs array<int>", runs)


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def repeated_spans(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN
) -> DataFrame:
    """``key``, ``tid`` (hash of the text) and ``marks`` of texts with repeats.

    Each mark has a segment's first start and the runs of repeated starts in it.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("tid"), F.col(text_col).alias("text"))

    def anchors(given: Iterator[tuple]) -> Iterator[tuple]:
        for key, tid, text in given:
            found = list(anchored(_utf8(text), span))
            if found:
                yield (key, tid, *map(list, zip(*found)))

    schema = f"key {kind}, tid long, anchor array<long>, first array<long>, last array<long>, places array<int>"
    found = stage(map_rows(texts, schema, anchors, 256), folder, "anchors")
    flat = found.select("key", "tid", F.explode(F.arrays_zip("anchor", "first", "last", "places")).alias("s"))
    flat = flat.select("key", "tid", "s.*")
    often = flat.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1")
    wanted = flat.join(often, "anchor").groupBy("key", "tid").agg(
        F.collect_set(F.struct("first", "last", "anchor", (F.col("n") > HOT_PLACES).alias("hot"))).alias("segments")
    )
    wanted = wanted.select(F.col("key").alias("k"), F.col("tid").alias("t"), "segments")

    def cut(given: Iterator[tuple]) -> Iterator[tuple]:
        seen: set[bytes] = set()
        for key, tid, text, segments in given:
            data = _utf8(text)
            for s in segments:
                parts = [(s["anchor"], s["first"], s["last"])]
                for anchor, first, last in split_hot(data, *parts[0], span) if s["hot"] else parts:
                    body = data[first : last + span]
                    name = xxhash.xxh3_128_digest(body, seed=anchor % (1 << 64))
                    if len(seen) >= MEMO:
                        seen.clear()
                    yield key, tid, first, anchor, name, None if name in seen else body
                    seen.add(name)

    chosen = texts.join(wanted, F.col("key").eqNullSafe(F.col("k")) & (F.col("tid") == F.col("t")))
    schema = f"key {kind}, tid long, first long, anchor long, name binary, body binary"
    segments = map_rows(chosen.select("key", "tid", "text", "segments"), schema, cut, 1024)
    segments = stage(segments, folder, "segments")
    counts = segments.groupBy("anchor", "name").agg(
        F.count("*").alias("n"), F.max(F.octet_length("body").cast("long")).alias("size")
    )
    counts = stage(counts, folder, "counts")
    large = counts.groupBy(F.col("anchor").alias("a")).agg(F.sum("size").alias("size")).where(F.col("size") > GROUP_BYTES)
    large = stage(large.select("a"), folder, "large")
    is_large = F.col("anchor") == F.col("a")
    counts, single = counts.join(large, is_large, "left_anti"), counts.join(large, is_large, "left_semi")
    size = counts.agg(F.sum("size")).first()[0] or 0
    bodies = segments.where("body is not null").select("anchor", "name", "body", F.lit(None).cast("long").alias("n"))
    single = _single_starts(bodies.join(large, is_large, "left_semi"), single, folder, span)
    bodies = bodies.join(large, is_large, "left_anti")
    given = bodies.unionByName(counts.select("anchor", "name", F.lit(None).cast("binary").alias("body"), "n"))
    given = given.withColumn("kind", F.col("n").isNull()).repartition(max(8, -(-size // PARTITION_BYTES)), "anchor")

    def index(rows: Iterator[tuple]) -> Iterator[tuple]:
        family, numbers = IndexFamily(span), {}
        batch, held = ([], [], [], []), 0
        for is_body, anchor, name, body, n in rows:
            if not is_body:
                numbers[name] = n
                continue
            n = numbers.pop(name, None)
            if n is None:  # another task sent the same segment
                continue
            for column, value in zip(batch, (name, anchor, bytes(body), n > 1)):
                column.append(value)
            held += len(body)
            if held >= BATCH_BYTES:
                family.add(*batch)
                batch, held = ([], [], [], []), 0
        if held:
            family.add(*batch)
        yield from family.repeats()

    given = given.sortWithinPartitions("kind").select("kind", "anchor", "name", "body", "n")
    ranges = map_rows(given, "segment binary, runs array<int>", index).unionByName(single)
    ranges = stage(ranges, folder, "ranges")
    marked = segments.select("key", "tid", "first", "name").join(ranges, F.col("name") == F.col("segment"))
    return marked.groupBy("key", "tid").agg(F.collect_list(F.struct("first", "runs")).alias("marks"))


def removed_bytes(marks: list, span: int) -> list[tuple[int, int]]:
    """Covered bytes as disjoint spans in order, from repeated starts."""
    out: list[tuple[int, int]] = []
    for first, last in sorted((m["first"] + a, m["first"] + b) for m in marks for a, b in zip(m["runs"][::2], m["runs"][1::2])):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + span))
        else:
            out.append((first, last + span))
    return out


def remove_repeats(
    docs: DataFrame,
    marks: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = SPAN,
    as_text: bool = False,
) -> DataFrame:
    """All columns of ``docs`` and ``repeat``: ``n_bytes``, removed ``spans`` (start and end byte) and ``kept`` bytes.

    With ``as_text`` what is kept is a text; bytes of a character that was cut are left out.

    ``marks`` comes from ``repeated_spans`` over the same table. A byte is removed if a string of ``span`` bytes over it
    starts anywhere else, in the same text too; strings do not cross texts. A null text is empty. Repeated rows are
    repeats of each other. Texts shorter than the span are kept.
    """
    k, t, m = (f"__{name}_{id(docs):x}" for name in ("key", "text", "marks"))
    marks = marks.select(F.col("key").alias(k), F.col("tid").alias(t), F.col("marks").alias(m))
    joined = docs.join(marks, docs[id_col].eqNullSafe(marks[k]) & (F.xxhash64(docs[text_col]) == marks[t]), "left")
    return joined.withColumn("repeat", _remover(span, as_text)(F.col(text_col), F.col(m))).drop(k, t, m)


def _in_slices(fn, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``fn`` of each row; few rows at a time are Python objects."""
    parts = [
        pa.array(list(map(fn, *[values.to_pylist() for values in part])), kind)
        for part in zip(*[slices([column]) for column in columns])
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _remover(span: int, as_text: bool):
    kind = pa.struct(
        {
            "n_bytes": pa.int64(),
            "spans": pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()})),
            "kept": pa.string() if as_text else pa.binary(),
        }
    )

    def cut(text: str | None, found: list | None) -> dict:
        data = _utf8(text)
        spans = removed_bytes(found, span) if found is not None else []
        edges = [0, *(x for pair in spans for x in pair), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        kept = kept.decode("utf-8", "ignore") if as_text else kept
        return {"n_bytes": len(data), "spans": [{"start": a, "end": b} for a, b in spans], "kept": kept}

    def remove(texts: pa.Array, marks: pa.Array) -> pa.Array:
        return _in_slices(cut, kind, texts, marks)

    types = f"struct<n_bytes: long, spans: array<struct<start: long, end: long>>, kept: {'string' if as_text else 'binary'}>"
    return F.arrow_udf(remove, types)
