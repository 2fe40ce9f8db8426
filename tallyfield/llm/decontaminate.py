"""Benchmark decontamination by winnowing.

Documents and items keep, of each run of consecutive ``k``-gram hashes, the smallest one. A shared passage of
``window`` words holds ``window - k + 1`` k-grams, and a run of that many has the same smallest hash in both texts, so
each shared passage shares a kept fingerprint. Shared fingerprints are extended word by word to the longest common
span; spans of at least ``window`` words are hits. Items shorter than the window are one window of their own length,
found by the hash of all their words.

The items are read in blocks of a stated size; every document meets every block where it lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, ngram_hashes

WINDOW = 13
GRAM = 6
#: Share of hit words from which a document is contaminated.
PERCENT = 5
#: Characters of item text in a block: what a task holds of the benchmark at once.
BLOCK_CHARS = 1 << 24

#: Bytes of words, A-Z in lower case; all others part words.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z and all that is not ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def winnow(hashes: np.ndarray, run: int) -> np.ndarray:
    """Places of the smallest hash of each run (the last of equal ones); fewer hashes are one run."""
    if len(hashes) == 0:
        return np.empty(0, np.int64)
    run = min(run, len(hashes))
    rows = np.lib.stride_tricks.sliding_window_view(hashes, run)[:, ::-1]
    return np.unique(np.arange(len(rows)) + run - 1 - rows.argmin(axis=1))


class Matcher:
    """A block of items, ready to find their windows in documents."""

    def __init__(self, items: list[tuple], window: int, k: int):
        self.window, self.k, self.run = window, k, window - k + 1
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple] = []
        prints: list[tuple[int, int, int]] = []
        self.short: dict[int, dict[int, list[int]]] = {}
        for key, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)], np.uint64)
            if not len(ids):
                continue
            at = len(self.items)
            self.items.append((key, ids))
            if len(ids) < window:
                self.short.setdefault(len(ids), {}).setdefault(int(ngram_hashes(ids, len(ids))[0]), []).append(at)
            else:
                grams = ngram_hashes(ids, k)
                prints += [(int(grams[p]), at, int(p)) for p in winnow(grams, self.run)]
        prints.sort()
        self.hashes = np.array([p[0] for p in prints], np.uint64)
        self.places = [p[1:] for p in prints]
        self.distinct = np.unique(self.hashes)

    def _extend(self, ids: np.ndarray, p: int, item: np.ndarray, q: int) -> tuple[int, int]:
        """The longest common span through the k-grams at ``p`` and ``q``, empty if they differ."""
        back, ahead = min(p, q), min(len(ids) - p, len(item) - q)
        same = ids[p - back : p + ahead] == item[q - back : q + ahead]
        if not same[back : back + self.k].all():
            return p, p
        left, right = np.flatnonzero(~same[:back]), np.flatnonzero(~same[back:])
        return p - back + (left[-1] + 1 if len(left) else 0), p + (right[0] if len(right) else ahead)

    def hits(self, text: str | None) -> tuple[int, list[tuple[int, int]], list]:
        """Words of a text, spans of hit words, items whose windows occur."""
        found = words(text)
        ids = np.array([self.vocabulary.get(w, 0) for w in found], np.uint64)
        spans, items = [], set()
        for part in _stretches(ids, min([self.window, *self.short])):
            ids_here = ids[part]
            if len(ids_here) >= self.window and len(self.hashes):
                grams = ngram_hashes(ids_here, self.k)
                places = winnow(grams, self.run)
                at = np.searchsorted(self.distinct, grams[places])
                shared = places[self.distinct[np.minimum(at, len(self.distinct) - 1)] == grams[places]]
                done: dict[tuple[int, int], int] = {}  # the end of the last span, by item and shift
                for p in shared.tolist():
                    lo, hi = np.searchsorted(self.hashes, grams[p]), np.searchsorted(self.hashes, grams[p], "right")
                    for item, q in self.places[lo:hi]:
                        if done.get((item, p - q), -1) >= p + self.k:
                            continue
                        start, end = self._extend(ids_here, p, self.items[item][1], q)
                        done[(item, p - q)] = end
                        if end - start >= self.window:
                            spans.append((part.start + start, part.start + end))
                            items.add(item)
            for size, known in self.short.items():
                if len(ids_here) < size:
                    continue
                for p, h in enumerate(ngram_hashes(ids_here, size).tolist()):
                    for item in known.get(h, ()):
                        if np.array_equal(ids_here[p : p + size], self.items[item][1]):
                            spans.append((part.start + p, part.start + p + size))
                            items.add(item)
        return len(found), merged(spans), sorted({self.items[i][0] for i in items}, key=lambda x: (x is None, str(x)))


def _stretches(ids: np.ndarray, least: int) -> Iterator[slice]:
    """Stretches of words that occur in the items, if long enough."""
    known = np.concatenate(([False], ids > 0, [False]))
    edges = np.flatnonzero(known[1:] != known[:-1])
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - start >= least:
            yield slice(start, end)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The benchmark in blocks of bounded text (or one longer item each), fetched one at a time."""
    block, size = [], 0
    for key, text in items.select(F.col(id_col), F.col(text_col)).where(F.col(text_col).isNotNull()).toLocalIterator():
        if block and size + len(text) > chars:
            yield block
            block, size = [], 0
        block.append((key, text))
        size += len(text)
    yield block


@lru_cache(maxsize=2)
def _matcher(items: tuple, window: int, k: int) -> Matcher:
    return Matcher(list(items), window, k)


def _scanner(held, schema: str, window: int, k: int):
    @F.pandas_udf(schema)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = _matcher(held.value, window, k)
        for texts in batches:
            rows = [matcher.hits(text) for text in texts]
            yield pd.DataFrame(
                {
                    "words": [r[0] for r in rows],
                    "spans": [[{"start": a, "end": b} for a, b in r[1]] for r in rows],
                    "items": [[str(i) for i in r[2]] for r in rows],
                }
            )

    return scan


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    k: int = GRAM,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Spans of each text that occur in a benchmark item: all columns of ``docs`` and ``hit``.

    ``hit`` is a struct of ``words``, ``spans`` (start and end word) and ``items`` (ids as text). A null or empty text
    has no words and no hits; so has every text if the benchmark is empty. Repeated rows are answered each, items with
    one id count once, one word matches many items.
    """
    session = docs.sparkSession
    schema = "struct<words: long, spans: array<struct<start: long, end: long>>, items: array<string>>"
    found = []
    for block in item_blocks(items, item_col, item_text, block_chars):
        held = session.sparkContext.broadcast(tuple(block))  # at most block_chars of text
        found.append(_scanner(held, schema, window, k)(F.col(text_col)))
    if len(found) == 1:
        return docs.withColumn("hit", found[0])
    parts = F.array(*found)
    whole = F.struct(
        F.element_at(parts, 1)["words"].alias("words"),
        F.flatten(F.transform(parts, lambda p: p["spans"])).alias("spans"),
        F.array_distinct(F.flatten(F.transform(parts, lambda p: p["items"]))).alias("items"),
    )
    return docs.withColumn("hit", whole)


def covered_words(spans: F.Column) -> F.Column:
    """Words in the union of spans."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    add = lambda done, s: F.struct(
        (done["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], done["end"]))).alias("n"),
        F.greatest(done["end"], s["end"]).alias("end"),
    )
    return F.aggregate(ordered, start, add)["n"]


def _is_contaminated(n_words: F.Column, n_hit: F.Column, percent: int) -> F.Column:
    return (n_hit > 0) & (100 * n_hit >= percent * n_words)


def clean(found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``find_contamination`` that are not contaminated."""
    return found.where(~_is_contaminated(F.col("hit.words"), covered_words(F.col("hit.spans")), percent))


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", percent: int = PERCENT, **options
) -> DataFrame:
    """Counts and verdict per document: at least one hit word and at least ``percent`` of all words hit."""
    found = find_contamination(docs, items, id_col=id_col, **options).select(F.col(id_col), "hit")
    return found.select(
        F.col(id_col),
        F.col("hit.words").alias("n_words"),
        covered_words(F.col("hit.spans")).alias("n_hit"),
        F.size("hit.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit.items"), ","), 256).alias("items_sha256"),
        F.col("hit.spans").alias("spans"),
    ).withColumn("contaminated", _is_contaminated(F.col("n_words"), F.col("n_hit"), percent))
