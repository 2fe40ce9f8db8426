"""Removal of repeated word windows by relative Lempel-Ziv parsing.

A window is a run of ``window`` words of one text; it repeats if its words start earlier, in a text with a smaller id or
further to the front of the same one. Which texts can share a window is found by anchors: a window belongs to the
smallest hash of a word gram in it, so equal windows have one anchor, and neighbouring windows with one anchor are a
segment. Segments whose anchor has one place in the corpus hold no repeat and are left out.

All segments of an anchor are one part of one reference block, in the order of their first place in the corpus. A segment
that equals an earlier one is one factor. A different one is parsed greedily: the longest factor that the block has
earlier is looked up in the block's suffix array, by the nearest suffixes on both sides that begin earlier. Factors of
``window`` words or more are duplicate spans. The windows that a factor's end cuts are no part of a factor, so parsing
goes on at the first of them; behind a short factor, with the next word.

An anchor with very many places (a passage in many texts) is cut into its windows, each a segment of its own: then
equality of segments, which Spark counts with partial sums, is all there is to find, and no task holds the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from .common import MEMO, map_rows, mixed, slices, stage
from .suffixes import window_minima

WINDOW = 20
#: Words in the gram whose smallest hash is a window's anchor.
GRAM = 6
#: Windows of a segment at most.
SEGMENT = 2048
#: An anchor with more places than this is cut into windows.
HOT_PLACES = 4096
#: Words of a reference block, and bytes of segments in a partition on average.
BLOCK_WORDS, PARTITION_BYTES = 1 << 16, 1 << 23
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8; ASCII white space parts them."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def gram_hashes(hashes: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of ``gram`` word hashes."""
    size = len(hashes) - gram + 1
    out = hashes[:size]
    for i in range(1, gram):
        out = out * _FACTOR + hashes[i : i + size]
    return mixed(out)


def anchored(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window, and places of the anchor's gram, of each segment of a text."""
    if len(words) < window:
        return (np.zeros(0, np.int64),) * 4
    width = window - min(GRAM, window) + 1
    hashes = gram_hashes(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), min(GRAM, window))
    minima = window_minima(hashes, width)
    edges = np.flatnonzero(minima[1:] != minima[:-1]) + 1
    firsts = np.union1d(np.concatenate(([0], edges)), _cuts(edges, len(minima)))
    lasts = np.append(firsts[1:], len(minima)) - 1
    ordered = np.sort(hashes)
    if (ordered[1:] != ordered[:-1]).all():  # no gram twice in the text
        return minima[firsts].view(np.int64), firsts, lasts, np.ones(len(firsts), np.int64)
    known, ranks = np.unique(hashes, return_inverse=True)
    places = np.sort(ranks * (len(hashes) + 1) + np.arange(len(hashes)))
    own = np.searchsorted(known, minima[firsts]) * (len(hashes) + 1)
    times = np.searchsorted(places, own + lasts + width) - np.searchsorted(places, own + firsts)
    return minima[firsts].view(np.int64), firsts, lasts, times


def _cuts(edges: np.ndarray, size: int) -> np.ndarray:
    """Places that cut runs between edges to at most ``SEGMENT``."""
    bounds = np.concatenate(([0], edges, [size]))
    long = np.flatnonzero(np.diff(bounds) > SEGMENT)
    return np.concatenate([np.zeros(0, np.int64), *[np.arange(bounds[i] + SEGMENT, bounds[i + 1], SEGMENT) for i in long]])


class ReferenceBlock:
    """Segments one after another, their suffix array, and the longest earlier factor at each place."""

    def __init__(self, segments: list[list[bytes]]):
        sizes = np.array([len(s) for s in segments], np.int64)
        flat = [word for segment in segments for word in segment]
        known = {word: i for i, word in enumerate(dict.fromkeys(flat))}
        self.ends = np.cumsum(sizes + 1) - 1  # places of the separators, each of which is a word of its own
        self.starts = self.ends - sizes
        codes = np.zeros(len(flat) + len(segments), np.int64)
        inside = np.ones(len(codes), bool)
        inside[self.ends] = False
        codes[inside] = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
        codes[self.ends] = len(known) + np.arange(len(segments))
        self.levels = self._levels(codes)
        self.factors = self._longest_earlier()

    @staticmethod
    def _levels(codes: np.ndarray) -> list[np.ndarray]:
        """Ranks of the 1, 2, 4, ... words at each place, until all places differ; behind the end is rank 0."""
        ranks = [np.append(codes + 1, 0)]
        while True:
            now, size = ranks[-1], 1 << (len(ranks) - 1)
            behind = np.zeros(len(now), np.int64)
            behind[: max(0, len(now) - size)] = now[size:]
            names, next_ = np.unique(now * (len(now) + len(codes) + 2) + behind, return_inverse=True)
            ranks.append(next_)
            if len(names) == len(now):
                return ranks

    def _longest_earlier(self) -> np.ndarray:
        """Words that each place shares with the earlier place that shares most."""
        order = np.argsort(self.levels[-1])[1:].tolist()  # the first suffix is the empty one
        size = len(order)
        before, after = [-1] * size, [-1] * size
        stack: list[int] = []
        for place in order:
            while stack and stack[-1] > place:
                after[stack.pop()] = place
            if stack:
                before[place] = stack[-1]
            stack.append(place)
        return np.maximum(*(self._shared(np.array(x, np.int64)) for x in (before, after)))

    def _shared(self, other: np.ndarray) -> np.ndarray:
        """Words that each place shares with another one, 0 with none."""
        mine, length, last = np.arange(len(other)), np.zeros(len(other), np.int64), len(other)
        there = other >= 0
        for k in range(len(self.levels) - 1, -1, -1):
            ranks = self.levels[k]
            a, b = np.minimum(mine + length, last), np.minimum(other + length, last)
            length += np.where(there & (ranks[a] == ranks[b]) & (a < last) & (b < last), 1 << k, 0)
        return length

    def parse(self, segment: int, window: int) -> list[int]:
        """First and last repeated window of each run in a segment, as one flat list."""
        runs: list[int] = []
        factors = self.factors[self.starts[segment] : self.ends[segment]]
        long = np.flatnonzero(factors >= window)  # where a long factor can begin
        at = 0
        while at < len(long):
            first = int(long[at])
            last = first + int(factors[first]) - window
            if runs and runs[-1] == first - 1:
                runs[-1] = last
            else:
                runs += [first, last]
            at = int(np.searchsorted(long, last + 1))  # the first window that the factor's end cuts, or one behind
        return runs


def _position(id_col: Column, first: Column, is_integral: bool) -> Column:
    """A value that orders windows by document and place; rows without an id come first."""
    if not is_integral:
        return F.struct(id_col.alias("key"), first.alias("first"))
    key = F.coalesce(id_col.cast("decimal(20,0)"), F.lit("-9223372036854775809").cast("decimal(20,0)"))
    return (key * F.lit(1 << 31).cast("decimal(10,0)") + first.cast("decimal(10,0)")).cast("decimal(38,0)")


def repeated_windows(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot: int = HOT_PLACES
) -> DataFrame:
    """``key``, ``tid`` (hash of the text) and ``marks`` of texts with windows that start earlier elsewhere.

    Each mark has a segment's first window and the runs of repeated windows in it. ``folder`` takes the staged tables.
    """
    field = docs.schema[id_col].dataType
    kind, is_integral = field.simpleString(), isinstance(field, IntegralType)
    texts = docs.select(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("tid"), F.col(text_col).alias("text"))

    def anchors(given: Iterator[tuple]) -> Iterator[tuple]:
        for tid, text in given:
            found = anchored(words_of(text), window)
            if len(found[0]):
                yield tid, *found

    schema = "tid long, anchor array<long>, first array<int>, last array<int>, places array<int>"
    found = map_rows(texts.select("tid", "text"), schema, anchors, 256)
    found = stage(found, folder, "anchors")
    flat = found.select("tid", F.explode(F.arrays_zip("anchor", "first", "last", "places")).alias("s")).select("tid", "s.*")
    often = flat.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1")
    wanted = flat.join(often, "anchor").groupBy(F.col("tid").alias("t")).agg(
        F.collect_set(
            F.struct("first", "last", "anchor", (F.col("n") > hot).alias("hot"), (F.col("places") > 1).alias("again"))
        ).alias("segments")
    )
    wanted = stage(wanted, folder, "wanted")

    def cut(given: Iterator[tuple]) -> Iterator[tuple]:
        seen: set[bytes] = set()
        for key, tid, text, segments in given:
            words = words_of(text)
            for s in segments:
                first, last, anchor = s["first"], s["last"], s["anchor"]
                if s["hot"]:
                    for at in range(first, last + 1):
                        yield key, tid, at, 1, None, xxhash.xxh3_128_digest(b" ".join(words[at : at + window])), None, False
                    continue
                body = b" ".join(words[first : last + window])
                name = xxhash.xxh3_128_digest(body)
                if len(seen) >= MEMO:
                    seen.clear()
                yield key, tid, first, last - first + 1, anchor, name, None if name in seen else body, s["again"]
                seen.add(name)

    chosen = texts.join(wanted, F.col("tid") == F.col("t"))
    schema = f"key {kind}, tid long, first int, n int, anchor long, name binary, body binary, again boolean"
    segments = stage(map_rows(chosen.select("key", "tid", "text", "segments"), schema, cut, 1024), folder, "segments")
    placed = segments.withColumn("place", _position(F.col("key"), F.col("first"), is_integral))
    names = placed.groupBy("name").agg(F.min("place").alias("origin"), F.count("*").alias("n"), F.max("anchor").alias("anchor"))
    names = stage(names, folder, "names")
    size = segments.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    given = segments.where("body is not null").select("anchor", "name", "body", "again")
    given = given.unionByName(names.where("anchor is not null").select("anchor", "name", "origin"), allowMissingColumns=True)
    given = given.repartition(max(8, -(-size // PARTITION_BYTES)), "anchor").sortWithinPartitions("anchor")

    def parse(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple[bytes, list[bytes]]] = []
        words = 0
        for group in _groups(rows):
            held += group
            words += sum(len(segment) for _, segment in group)
            if words >= BLOCK_WORDS:
                yield from _parsed(held, window)
                held, words = [], 0
        if held:
            yield from _parsed(held, window)

    parsed = map_rows(given.select("anchor", "name", "body", "origin", "again"), "part binary, runs array<int>", parse)
    found = names.join(stage(parsed, folder, "parsed"), F.col("name") == F.col("part"), "left").where("n > 1 or runs is not null")
    found = stage(found.select(F.col("name").alias("same"), "origin", "runs"), folder, "found")
    runs = F.when(F.col("place") > F.col("origin"), F.array(F.lit(0), F.col("n") - 1)).otherwise(F.col("runs"))
    marked = placed.select("key", "tid", "first", "n", "name", "place").join(found, F.col("name") == F.col("same"))
    marked = marked.withColumn("runs", runs).where("runs is not null")
    return marked.groupBy("key", "tid").agg(F.collect_set(F.struct("first", "runs")).alias("marks"))


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple[bytes, list[bytes]]]]:
    """Names and words of the distinct segments of each anchor that may hold repeats, by their first place."""
    now, bodies, origins, may = None, {}, {}, False
    for anchor, name, body, origin, again in chain(rows, [(None,) * 5]):
        if anchor != now:
            if may or len(bodies) > 1:
                yield [(n, bodies[n].split()) for n in sorted(bodies, key=lambda n: _order(origins[n]))]
            now, bodies, origins, may = anchor, {}, {}, False
        if body is None:
            origins[name] = origin
        else:
            bodies[name], may = body, may or again


def _order(origin):
    """A sortable form of a position."""
    return (origin["key"] is not None, origin["key"], origin["first"]) if isinstance(origin, dict) else origin


def _parsed(held: list[tuple[bytes, list[bytes]]], window: int) -> Iterator[tuple[bytes, list[int]]]:
    block = ReferenceBlock([words for _, words in held])
    for i, (name, _) in enumerate(held):
        runs = block.parse(i, window)
        if runs:
            yield name, runs


def removed_words(marks: list, window: int) -> list[tuple[int, int]]:
    """Covered words as disjoint spans in order, from repeated windows."""
    out: list[tuple[int, int]] = []
    for first, last in sorted((m["first"] + a, m["first"] + b) for m in marks for a, b in zip(m["runs"][::2], m["runs"][1::2])):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + window))
        else:
            out.append((first, last + window))
    return out


def remove_repeats(
    docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """All columns of ``docs`` and ``repeat``: ``n_words``, removed ``spans`` (start and end word) and ``kept``, a text.

    ``marks`` comes from ``repeated_windows`` over the same table. A word is removed if a window over it starts earlier:
    in a row with a smaller id, or in the same document further to the front. Rows with one id are one document, so
    equal rows, and windows of theirs at the same place, are no repeats of each other; rows without an id are one
    document before all others. Kept words are joined by one space. A null text has no words; texts with fewer words
    than a window are kept. An empty table gives an empty table.
    """
    k, t, m = (f"__{name}_{id(docs):x}" for name in ("key", "text", "marks"))
    marks = marks.select(F.col("key").alias(k), F.col("tid").alias(t), F.col("marks").alias(m))
    joined = docs.join(marks, docs[id_col].eqNullSafe(marks[k]) & (F.xxhash64(docs[text_col]) == marks[t]), "left")
    return joined.withColumn("repeat", _remover(window)(F.col(text_col), F.col(m))).drop(k, t, m)


def _remover(window: int):
    span = pa.struct({"start": pa.int64(), "end": pa.int64()})
    kind = pa.struct({"n_words": pa.int64(), "spans": pa.list_(span), "kept": pa.string()})

    def cut(text: str | None, found: list | None) -> dict:
        words = words_of(text)
        spans = removed_words(found, window) if found is not None else []
        edges = [0, *(x for pair in spans for x in pair), len(words)]
        kept = b" ".join([word for a, b in zip(edges[::2], edges[1::2]) for word in words[a:b]])
        return {"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "kept": kept.decode("utf-8")}

    def remove(texts: pa.Array, marks: pa.Array) -> pa.Array:
        parts = [
            pa.array(list(map(cut, *[values.to_pylist() for values in part])), kind)
            for part in zip(slices([texts]), slices([marks]))
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return F.arrow_udf(remove, "struct<n_words: long, spans: array<struct<start: long, end: long>>, kept: string>")
