"""Packing by best-fit decreasing, planned on the histogram of piece lengths.

Pieces of one length can be exchanged for one another, so best-fit decreasing depends on lengths alone, and bins with
the same history move together. The plan works on such groups of bins: a segment tree over remaining capacities finds
the tightest group that a length fits in, and the group is cut where its pieces end. The histogram has at most
``window`` rows whatever the corpus, and so does each step of the plan. Pieces find their bin by their rank among
pieces of their length: tasks number their own pieces while they encode, and a small table of counts by task and length
says how many lie before them. Ids are packed bytes, written once and sent once, by sequence.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import MEMO, map_rows, remember_only, stage
from .tokens import ODD_SPACE, PLAIN_LETTERS, PLAIN_WORD, SHORT, SPACE, lowers_plain_words

WINDOW = 2048
#: Rows of the table of counts up to which it is sent to all tasks; a larger one is joined.
OFFSET_ROWS = 1 << 20
#: Bytes of ids in a partition of sequences on average.
PARTITION_BYTES = 1 << 24


class TokenIds:
    """Ids of texts by a tokenizer file, as little-endian bytes of one width; runs without white space are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.runs: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.plain = lowers_plain_words(self.tokenizer)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str if self.plain else None
        self.alphabet = {ord(c): pieces(c)[0][0] for c in PLAIN_LETTERS} if self.plain else {}
        self.model = self.tokenizer.model

    def packed(self, ids: Iterable[int]) -> bytes:
        """Ids as bytes."""
        return array(self.code, ids).tobytes()

    def part(self, text: str, plain: bool = False) -> bytes:
        """Ids of a piece that is encoded for itself; plain letters and marks go straight to the library's model."""
        found = self.parts.get(text)
        if found is None:
            if len(self.parts) >= MEMO // 2:
                self.parts.clear()
            if plain:
                text_ = text if text.isascii() else text.translate(self.alphabet)
                found = self.packed([token.id for token in self.model.tokenize(text_)])
            else:
                found = self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
            if len(text) <= SHORT:
                self.parts[text] = found
        return found

    def run(self, text: str) -> bytes:
        """Ids of symbols without white space; letters and the marks behind them are pieces of their own."""
        found = self.runs.get(text)
        if found is None:
            if len(self.runs) >= MEMO // 2:
                self.runs.clear()
            plain = PLAIN_WORD.fullmatch(text) if self.plain else None
            if plain:
                found = self.part(plain[1].lower(), True) + (self.part(plain[2], True) if plain[2] else b"")
            else:
                found = self.part(text)
            if len(text) <= SHORT:
                self.runs[text] = found
        return found

    def clear(self) -> None:
        """Forget all runs and pieces."""
        self.runs.clear()
        self.parts.clear()

    def of(self, text: str) -> bytes:
        """White space separates runs that are encoded independently (see ``tokens``)."""
        words = [w for w in SPACE.split(text) if w] if ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.run, words))


@lru_cache(maxsize=4)
def token_ids(path: str) -> TokenIds:
    """The encoder of a file; a Python worker keeps it from task to task."""
    return TokenIds(path)


def cut(length: int, window: int) -> list[tuple[int, int]]:
    """Full windows, then the rest, as (start, length)."""
    return [(at, min(window, length - at)) for at in range(0, length, window)]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every text's ids and ``end_id``, cut into pieces of at most ``window``.

    Returns ``id_col``, ``start``, ``length``, ``doc_tokens``, ``ids`` (little-endian, 2 or 4 bytes each by the size of
    the vocabulary), and for ``pack``: ``task`` and ``nth``, the piece's place among those of its length in its task. A
    null text is empty, its piece is the end id alone; repeated rows give their pieces each; an empty table gives none.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start long, length int, doc_tokens long, ids binary, task int, nth long"

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        encoder = token_ids(tokenizer)
        remember_only(encoder)
        tail = encoder.packed([end_id])
        width, task, before = len(tail), TaskContext.get().partitionId(), Counter()
        for key, text in given:
            ids = encoder.of(text or "") + tail
            for start, length in cut(len(ids) // width, window):
                part = ids[width * start : width * (start + length)]
                yield key, start, length, len(ids) // width, part, task, before[length]
                before[length] += 1

    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, rows, 512)


class CapacityTree:
    """Groups of bins by remaining capacity; finds the smallest capacity that is at least a length."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [False] * (2 * self.leaves)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _mark(self, leaf: int) -> None:
        node = leaf + self.leaves
        self.filled[node] = bool(self.groups[leaf])
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] or self.filled[2 * node + 1]

    def add(self, capacity: int, first: int, bins: int) -> None:
        if bins:
            self.groups[capacity].append((first, bins))
            self._mark(capacity)

    def take(self, length: int) -> tuple[int, int, int] | None:
        """Remove and return the tightest group as (capacity, first bin, bins)."""
        node = length + self.leaves
        while not self.filled[node]:
            while node % 2:  # a right child: go up until there is something to the right
                if node == 1:
                    return None
                node //= 2
            node += 1
            if node & (node - 1) == 0:  # wrapped to the next level: nothing to the right
                return None
        while node < self.leaves:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        group = self.groups[capacity].pop()
        self._mark(capacity)
        return capacity, *group


def plan(histogram: Iterable[tuple[int, int]], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over (length, pieces).

    Returns (length, first rank, pieces, first bin, pieces a bin, offset): the pieces of that length and those ranks
    fill bins from the first on, so many in each, from that offset.
    """
    tree, steps, bins = CapacityTree(window), [], 0
    for length, left in sorted(histogram, reverse=True):
        rank = 0
        while left:
            group = tree.take(length)
            if group is None:
                each = window // length
                group = (window, bins, -(-left // each))
                bins += group[2]
            capacity, first, size = group
            each = min(capacity // length, left)
            used = min(size, left // each)
            take = used * each
            steps.append((length, rank, take, first, each, window - capacity))
            tree.add(capacity, first + used, size - used)
            tree.add(capacity - each * length, first, used)
            rank += take
            left -= take
    return steps


def pack(pieces: DataFrame, folder: str, window: int = WINDOW) -> DataFrame:
    """Put pieces of 1 to ``window`` tokens into sequences: all columns but ``task`` and ``nth``, ``sequence_id``, ``offset``.

    ``pieces`` is what ``token_pieces`` returns. Sequences are numbered from 0 without gaps, offsets in each too. Which
    of several pieces of one length comes first depends on the tasks that read the texts. ``folder`` takes the pieces.
    An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    given = stage(pieces, folder, "pieces")
    counts = stage(given.groupBy("length", "task").agg(F.count("*").alias("n")), folder, "counts")
    histogram = [tuple(r) for r in counts.groupBy("length").agg(F.sum("n")).collect()]  # at most one row a length
    if any(not 0 < n <= window for n, _ in histogram):
        raise ValueError(f"Pieces must have 1 to {window} tokens.")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")  # at most a row a task
    offsets = stage(counts.select("length", "task", before.alias("before")), folder, "offsets")
    if offsets.count() <= OFFSET_ROWS:
        offsets = F.broadcast(offsets)
    columns = zip(*plan(histogram, window)) if histogram else [[]] * 6
    names = ["length", "first", "n", "bin", "each", "shift"]
    steps = spark.createDataFrame(pa.table({name: pa.array(list(c), pa.int64()) for name, c in zip(names, columns)}))
    steps = steps.groupBy("length").agg(F.collect_list(F.struct("first", "n", "bin", "each", "shift")).alias("steps"))
    ranked = given.join(offsets, ["length", "task"]).join(F.broadcast(steps), "length")  # at most a row a length
    rank = F.col("before") + F.col("nth")
    step = F.filter("steps", lambda s: (rank >= s["first"]) & (rank < s["first"] + s["n"])).getItem(0)
    at = (rank - F.col("step")["first"]) % F.col("step")["each"]
    bin_ = F.col("step")["bin"] + F.floor((rank - F.col("step")["first"]) / F.col("step")["each"])
    return ranked.withColumn("step", step).select(
        *[c for c in pieces.columns if c not in ("task", "nth")],
        bin_.cast("long").alias("sequence_id"),
        (F.col("step")["shift"] + at * F.col("length")).cast("int").alias("offset"),
    )


def sequence_lengths(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Tokens of every sequence, and the length it is padded to: ``window``, or its own at a power of two."""
    filled = packed.groupBy("sequence_id").agg(F.sum("length").cast("long").alias("tokens"))
    power = F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0
    return filled.withColumn("padded", F.when(power, F.col("tokens")).otherwise(F.lit(window).cast("long")))


def padded(pieces: list[tuple[int, bytes]], width: int, pad_id: int, window: int) -> np.ndarray:
    """The ids of one sequence from its pieces by offset, and padding up to ``window`` unless they are a power of two."""
    ids = np.frombuffer(b"".join(part for _, part in sorted(pieces)), f"<u{width}").astype("<u4")
    size = len(ids)
    return ids if size & (size - 1) == 0 else np.concatenate((ids, np.full(window - size, pad_id, "<u4")))


def _sequences(packed: DataFrame, carried: list[str], schema: str, emit, pad_id: int, window: int) -> DataFrame:
    """``emit`` of each sequence's number, padded ids and pieces (``carried``, then offset and length), one at a time."""
    size = 2 * (packed.agg(F.sum(F.col("length").cast("long"))).first()[0] or 0)
    names = ["sequence_id", "offset", "length", "ids", *carried]
    parts = packed.select(*names).repartition(max(8, -(-size // PARTITION_BYTES)), "sequence_id")
    parts = parts.sortWithinPartitions("sequence_id", "offset")

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        now, held = None, []
        for row in given:
            if row[0] != now and held:
                yield from whole(held)
                held = []
            now = row[0]
            held.append(row)
        if held:
            yield from whole(held)

    def whole(held: list[tuple]) -> Iterator[tuple]:
        width = len(held[0][3]) // held[0][2]
        ids = padded([(row[1], row[3]) for row in held], width, pad_id, window)
        return emit(held[0][0], ids, [(*row[4:], row[1], row[2]) for row in held])

    return map_rows(parts, schema, rows, 512)


def padded_sequences(packed: DataFrame, pad_id: int = 0, window: int = WINDOW) -> DataFrame:
    """The sequences themselves, from what ``pack`` returns: ``sequence_id`` and padded ``ids``."""

    def emit(number, ids, parts):
        yield number, ids.astype(np.int32)

    return _sequences(packed, [], "sequence_id long, ids array<int>", emit, pad_id, window)


def pieces_of(
    packed: DataFrame, carried: list[str], with_ids: bool = False, pad_id: int = 0, window: int = WINDOW
) -> DataFrame:
    """The pieces as they lie in the padded sequences.

    Returns the ``carried`` columns, ``length``, ``ids_crc32`` of the ids found there, ``sequence_id``, ``offset`` and,
    if asked for, ``ids``.
    """
    types = ", ".join(f"`{c}` {packed.schema[c].dataType.simpleString()}" for c in carried)
    schema = f"{types}, length long, ids_crc32 long, sequence_id long, offset long" + ", ids array<int>" * with_ids

    def emit(number, ids, parts):
        for *kept, offset, length in parts:
            part = ids[offset : offset + length]
            row = (*kept, length, zlib.crc32(part.tobytes()), number, offset)
            yield (*row, part.astype(np.int32)) if with_ids else row

    return _sequences(packed, carried, schema, emit, pad_id, window)
