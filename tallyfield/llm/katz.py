"""A bigram model with Katz backoff, scored where the texts lie.

Texts are cut into blocks of tokens. A block asks for each of its words once, and for each of its word pairs once: the
tables of words and of pairs are partitioned by hash, and every partition counts what all blocks ask for and answers
each block in the order of its question. So a frequent word or pair is one entry per block, however often it occurs.
Questions and answers are packed arrays, one row for a block and a partition.

Counts up to five are discounted after Good and Turing (half a count where the counts of counts do not allow it). What
a history loses is spread over the words that do not follow it, in proportion to their unigram share, with a weight
that makes all shares sum to one. Unigrams are discounted alike, and one unknown word has what they lose.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, mixed, stage

BLOCK_TOKENS = 1 << 21
#: Entries that a partition of the word and pair tables holds on average.
WORDS_EACH, PAIRS_EACH = 1 << 19, 1 << 21
#: Counts up to this one are discounted.
DISCOUNTED = 5
END = b""
#: Ids of the start of a text and of words that no training text has.
START, UNSEEN = (1 << 32) - 1, (1 << 32) - 2


def packed(values: np.ndarray) -> bytes:
    """Integers, compressed byte plane by byte plane."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype) -> np.ndarray:
    """The integers of ``packed``."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(data[0], -1).T).view(dtype).ravel()


def tokens_of(text: str | None) -> list[bytes]:
    """Words parted by ASCII white space, A-Z in lower case, and the end of the text."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def text_blocks(docs: DataFrame, learn: F.Column, id_col: str, text_col: str, size: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole texts: ``block``, keys, whether each text is learned from, lengths, places of its tokens among
    the block's distinct words, their hashes, and how often learned texts have each."""
    kind = docs.schema[id_col].dataType.simpleString()

    def block(number: int, keys: list, learned: list, lengths: list, parts: list, words: dict) -> tuple:
        places = np.concatenate(parts)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        places = rank[places]
        of = np.repeat(np.array(learned, bool), lengths)
        counts = np.bincount(places[of], minlength=len(words)).astype(np.uint32)
        return number, keys, learned, lengths, packed(places), packed(hashes[order]), packed(counts), len(words), len(places)

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << 32
        keys, learned, lengths, parts, words, total = [], [], [], [], {}, 0
        for key, text, teach in given:
            tokens = tokens_of(text)
            parts.append(np.fromiter((words.setdefault(t, len(words)) for t in tokens), np.uint32, len(tokens)))
            keys.append(key)
            learned.append(bool(teach))
            lengths.append(len(tokens))
            total += len(tokens)
            if total >= size:
                yield block(number, keys, learned, lengths, parts, words)
                number += 1
                keys, learned, lengths, parts, words, total = [], [], [], [], {}, 0
        if keys:
            yield block(number, keys, learned, lengths, parts, words)

    schema = (
        f"block long, keys array<{kind}>, learned array<boolean>, lengths array<int>, places binary, hashes binary, "
        "counts binary, n_words long, n_tokens long"
    )
    return map_rows(docs.select(F.col(id_col), F.col(text_col), learn), schema, rows, 1)


class Discount(NamedTuple):
    """What a count keeps: a factor for each count up to ``DISCOUNTED``, the first for 0."""

    factors: np.ndarray

    def of(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * np.where(
            counts <= DISCOUNTED, self.factors[np.minimum(counts, DISCOUNTED).astype(np.int64)], 1.0
        )


def discount(of_counts: np.ndarray) -> Discount:
    """From the numbers of entries with count 1, 2, ... ``DISCOUNTED`` + 1."""
    n, k = np.concatenate(([0.0], of_counts.astype(float))), DISCOUNTED
    factors = np.ones(k + 1)
    common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        factor = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
        factors[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return Discount(factors)


class Unigrams(NamedTuple):
    """Shares of words by their count; ``unseen`` belongs to all words without one."""

    tokens: int
    types: int
    texts: int
    kept: Discount
    unseen: float

    def share(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.kept.of(counts) / max(1, self.tokens), self.unseen)


def unigrams(tokens: int, types: int, texts: int, of_counts: np.ndarray, total: float, n_small: np.ndarray) -> Unigrams:
    """The model from token, type and text numbers; ``total`` is the sum of counts above ``DISCOUNTED``."""
    kept = discount(of_counts)
    if tokens == 0:
        return Unigrams(0, 0, 0, kept, 1.0)
    small = (np.arange(1, DISCOUNTED + 1) * kept.factors[1:] * n_small).sum()
    unseen = 1 - (small + total) / tokens
    if unseen <= 1e-12:  # nothing was discounted: one token more is set aside
        return Unigrams(tokens + 1, types, texts, kept, 1 / (tokens + 1))
    return Unigrams(tokens, types, texts, kept, unseen)


def _bucketed(keys: np.ndarray, buckets: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket numbers with the places of their sorted keys."""
    order = np.argsort(buckets, kind="stable")
    ends = np.searchsorted(buckets[order], np.arange(n + 1))
    for b in range(n):
        if ends[b + 1] > ends[b]:
            yield b, order[ends[b] : ends[b + 1]]


def _word_bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return (mixed(hashes) % np.uint64(n)).astype(np.int64)


def _of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)[
        1 : DISCOUNTED + 2
    ].tolist()


def word_table(blocks: DataFrame, buckets: int) -> DataFrame:
    """Counts and ids of words: an answer (``block`` set) for each block and partition, and one row of numbers each."""

    def ask(given: Iterator[tuple]) -> Iterator[tuple]:
        for block, hashes, counts in given:
            hashes, counts = unpacked(hashes, np.uint64), unpacked(counts, np.uint32)
            for bucket, at in _bucketed(hashes, _word_bucket(hashes, buckets), buckets):
                yield bucket, block, packed(hashes[at]), packed(counts[at])

    def answer(given: Iterator[tuple]) -> Iterator[tuple]:
        for bucket, rows in groupby(given, key=lambda r: r[0]):
            rows = [(r[1], unpacked(r[2], np.uint64), unpacked(r[3], np.uint32)) for r in rows]
            words, place = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([r[2] for r in rows])).astype(np.uint64)
            ids = np.empty(len(words), np.uint64)
            ids[np.argsort(-counts.astype(np.int64), kind="stable")] = np.arange(len(words), dtype=np.uint64)
            ids = ids * np.uint64(buckets) + np.uint64(bucket)
            if len(ids) and ids.max() >= UNSEEN:
                raise ValueError("More than 4 billion words; use more bits for ids.")
            ids[counts == 0] = UNSEEN
            above = int(counts[counts > DISCOUNTED].sum())
            yield bucket, None, None, None, [int(counts.sum()), int((counts > 0).sum()), above, *_of_counts(counts)]
            at = 0
            for block, hashes, _ in rows:
                mine = place[at : at + len(hashes)]
                at += len(hashes)
                yield bucket, block, packed(ids[mine].astype(np.uint32)), packed(counts[mine]), None

    asked = map_rows(blocks.select("block", "hashes", "counts"), "bucket int, block long, a binary, b binary", ask, 16)
    asked = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    return map_rows(asked, "bucket int, block long, ids binary, counts binary, numbers array<long>", answer, 16)


class Block(NamedTuple):
    """A block with what the word table answered."""

    keys: list
    learned: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    histories: np.ndarray
    history_counts: np.ndarray


def open_block(row: tuple, answers: list[tuple], buckets: int, texts: int) -> Block:
    """Ids and counts of each token and of the one before it."""
    _, keys, learned, lengths, places, hashes = row
    places, hashes = unpacked(places, np.uint32), unpacked(hashes, np.uint64)
    ids, counts = np.empty(len(hashes), np.uint64), np.empty(len(hashes), np.uint64)
    got = {bucket: (i, c) for bucket, i, c in answers}
    for bucket, at in _bucketed(hashes, _word_bucket(hashes, buckets), buckets):
        ids[at] = unpacked(got[bucket][0], np.uint32)
        counts[at] = unpacked(got[bucket][1], np.uint64)
    words, word_counts = ids[places], counts[places]
    lengths = np.array(lengths, np.int64)
    starts = np.cumsum(lengths) - lengths
    histories, history_counts = np.roll(words, 1), np.roll(word_counts, 1)
    histories[starts], history_counts[starts] = START, texts
    return Block(keys, np.array(learned, bool), lengths, words, word_counts, histories, history_counts)


def _pairs(block: Block, buckets: int, hot: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Distinct pairs behind known histories: keys, place of each token's pair, those tokens, first token of each
    pair, and the pairs of each partition. A history above ``hot`` tokens is spread over all partitions."""
    known = np.flatnonzero(block.history_counts > 0)
    keys = (block.histories[known] << np.uint64(32)) | block.words[known]
    pairs, first, place = np.unique(keys, return_index=True, return_inverse=True)
    first = known[first]
    spread = np.where(block.history_counts[first] > hot, pairs, pairs >> np.uint64(32))
    return pairs, place, known, first, list(_bucketed(pairs, _word_bucket(spread, buckets), buckets))


def _with_answers(blocks: DataFrame, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a block in front of the answers to it, in one task."""
    width = [f.name for f in answers.schema.fields if f.name != "block"]
    left = blocks.select(
        "block", F.lit(0).alias("kind"), F.struct(*columns).alias("row"),
        *[F.lit(None).cast(answers.schema[c].dataType).alias(c) for c in width],
    )
    right = answers.select("block", F.lit(1).alias("kind"), F.lit(None).cast(left.schema["row"].dataType).alias("row"), *width)
    both = left.unionByName(right).repartition(max(8, blocks.count()), "block").sortWithinPartitions("block", "kind", "source", "bucket")
    return both.select("block", "kind", "row", *width)


BLOCK_COLUMNS = ["block", "keys", "learned", "lengths", "places", "hashes"]


def _opened(given: Iterator[tuple], buckets: int, texts: int) -> Iterator[tuple[Block, list[tuple], int]]:
    """Each block with its answers from the pair table."""
    for number, rows in groupby(given, key=lambda r: r[0]):
        rows = list(rows)
        row = rows[0][2]
        words = [r[3:] for r in rows[1:] if r[3] == 0]
        yield (
            open_block(tuple(row[c] for c in BLOCK_COLUMNS), [(w[1], w[2], w[3]) for w in words], buckets, texts),
            [r[4:] for r in rows[1:] if r[3] == 1],
            number,
        )


def pair_table(joined: DataFrame, model: Unigrams, word_buckets: int, buckets: int, hot: float) -> DataFrame:
    """Counts of pairs for each block, and for each history what its counts add up to.

    An answer has, for the pairs that a block asked for, their counts, and for their histories the numbers of pairs
    with count 1 to ``DISCOUNTED``, the sum of larger counts, and the unigram share of all words that follow. Rows
    without a block have the same of spread histories, and counts of counts.
    """

    def ask(given: Iterator[tuple]) -> Iterator[tuple]:
        for block, _, number in _opened(given, word_buckets, model.texts):
            pairs, place, known, first, parts = _pairs(block, buckets, hot)
            teach = np.repeat(block.learned, block.lengths)[known]
            counts = np.bincount(place[teach], minlength=len(pairs)).astype(np.uint32)
            follows = block.counts[first]
            spread = (block.history_counts[first] > hot).astype(np.uint8)
            for bucket, at in parts:
                step = np.diff(pairs[at], prepend=np.uint64(0))
                yield bucket, number, packed(step), packed(counts[at]), packed(follows[at]), packed(spread[at])

    def answer(given: Iterator[tuple]) -> Iterator[tuple]:
        for bucket, rows in groupby(given, key=lambda r: r[0]):
            rows = [
                (r[1], np.cumsum(unpacked(r[2], np.uint64), dtype=np.uint64), unpacked(r[3], np.uint32), r[4], r[5])
                for r in rows
            ]
            keys = np.concatenate([r[1] for r in rows])
            pairs, first, place = np.unique(keys, return_index=True, return_inverse=True)
            counts = np.bincount(place, np.concatenate([r[2] for r in rows])).astype(np.uint64)
            shares = model.share(np.concatenate([unpacked(r[3], np.uint64) for r in rows])[first].astype(float))
            spread = np.concatenate([unpacked(r[4], np.uint8) for r in rows])[first]
            seen = counts > 0
            histories, at = np.unique(pairs >> np.uint64(32), return_inverse=True)
            n, width = len(histories), DISCOUNTED + 2
            sums = np.zeros((n, width))
            for r in range(1, DISCOUNTED + 1):
                sums[:, r - 1] = np.bincount(at[counts == r], minlength=n)
            large = counts > DISCOUNTED
            sums[:, DISCOUNTED] = np.bincount(at[large], counts[large], n)
            sums[:, DISCOUNTED + 1] = np.bincount(at[seen], shares[seen], n)
            wide = np.unique(at[spread > 0])
            yield 1, bucket, None, None, None, _of_counts(counts), histories[wide].astype(np.int64), sums[wide].ravel()
            where = 0
            for number, asked, *_ in rows:
                mine = place[where : where + len(asked)]
                where += len(asked)
                of = sums[np.unique(at[mine])]
                small = packed(of[:, : DISCOUNTED + 1].astype(np.uint64).ravel())
                rest = zstandard.ZstdCompressor(level=1).compress(of[:, DISCOUNTED + 1].tobytes())
                yield 1, bucket, number, packed(counts[mine].astype(np.uint32)), small + rest, [len(small)], None, None

    asked = map_rows(joined, "bucket int, block long, a binary, b binary, c binary, d binary", ask, 16)
    asked = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    schema = (
        "source int, bucket int, block long, ids binary, counts binary, numbers array<long>, "
        "spread array<long>, sums array<double>"
    )
    return map_rows(asked, schema, answer, 16)


def block_scores(
    block: Block, answers: list[tuple], model: Unigrams, kept: Discount, spread: tuple, buckets: int, hot: float
) -> np.ndarray:
    """log10 probability of each token of a block."""
    pairs, place, known, _, parts = _pairs(block, buckets, hot)
    counts = np.zeros(len(pairs))
    histories = np.unique(pairs >> np.uint64(32))
    sums = np.zeros((len(histories), DISCOUNTED + 2))
    got = {a[0]: a[1:] for a in answers}
    for bucket, at in parts:
        answer = got[bucket]
        counts[at] = unpacked(answer[0], np.uint32)
        size = answer[2][0]
        small = unpacked(answer[1][:size], np.uint64).reshape(-1, DISCOUNTED + 1)
        rest = np.frombuffer(zstandard.ZstdDecompressor().decompress(answer[1][size:]), np.float64)
        asked = np.searchsorted(histories, np.unique(pairs[at] >> np.uint64(32)))
        sums[asked, : DISCOUNTED + 1] = small
        sums[asked, DISCOUNTED + 1] = rest
    wide, wide_sums = spread
    if len(wide):
        at = np.minimum(np.searchsorted(wide, histories), len(wide) - 1)
        here = wide[at] == histories
        sums[here] = wide_sums[at[here]]
    total = np.zeros(len(histories))
    total[np.searchsorted(histories, block.histories[known])] = block.history_counts[known]
    # a history without a discounted pair sets one count aside, else nothing were left for other words
    bare = sums[:, :DISCOUNTED].sum(axis=1) == 0
    total += bare
    used = (sums[:, :DISCOUNTED] * (np.arange(1, DISCOUNTED + 1) * kept.factors[1:])).sum(axis=1) + sums[:, DISCOUNTED]
    share = model.share(block.counts.astype(float))
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = (1 - used / total) / (1 - sums[:, DISCOUNTED + 1])
        of = np.searchsorted(histories, pairs >> np.uint64(32))
        direct = kept.of(counts) / total[of]
    probability = share.copy()  # an unknown history says nothing
    mine = of[place]
    probability[known] = np.where(counts[place] > 0, direct[place], weight[mine] * share[known])
    return np.log10(probability)


def score_texts(
    docs: DataFrame,
    learn: F.Column,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Score every text by a model of the rows where ``learn`` holds.

    ``id_col``, ``learned``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``. A null text is
    empty and has its end as only token. Repeated rows are learned and scored each. Without a text to learn from all
    tokens have probability 1.
    """
    blocks = stage(text_blocks(docs, F.coalesce(learn, F.lit(False)), id_col, text_col, block_tokens), folder, "blocks")
    n_words, n_tokens = blocks.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    texts = blocks.select(F.sum(F.size(F.filter("learned", lambda x: x)).cast("long"))).first()[0] or 0
    word_buckets = max(8, -(-(n_words or 0) // WORDS_EACH))
    pair_buckets = max(8, -(-(n_tokens or 0) // PAIRS_EACH))
    words = stage(word_table(blocks, word_buckets), folder, "words")
    numbers = words.where("block is null").select(F.posexplode("numbers")).groupBy("pos").agg(F.sum("col").alias("n"))
    got = {r["pos"]: r["n"] for r in numbers.collect()}
    got = [got.get(i, 0) for i in range(4 + DISCOUNTED)]
    of_counts = np.array(got[3:])
    model = unigrams(got[0], got[1], texts, of_counts, got[2], of_counts[:DISCOUNTED])
    hot = max(1.0, got[0] / (8 * pair_buckets))
    asked = words.where("block is not null").select(
        "block", F.lit(0).alias("source"), "bucket", "ids", "counts", F.lit(None).cast("array<long>").alias("numbers")
    )
    joined = _with_answers(blocks, asked, BLOCK_COLUMNS)
    pairs = stage(pair_table(joined, model, word_buckets, pair_buckets, hot), folder, "pairs")
    numbers = pairs.where("block is null").select(F.posexplode("numbers")).groupBy("pos").agg(F.sum("col").alias("n"))
    kept_counts = {r["pos"]: r["n"] for r in numbers.collect()}
    kept = discount(np.array([kept_counts.get(i, 0) for i in range(DISCOUNTED + 1)]))
    width = DISCOUNTED + 2
    spread: dict[int, np.ndarray] = {}
    for histories, sums in pairs.where("block is null").select("spread", "sums").toLocalIterator():
        for h, s in zip(histories, np.array(sums).reshape(-1, width)):  # at most 8 histories for each partition
            spread[h] = spread.get(h, 0) + s
    wide = np.array(sorted(spread), np.uint64)
    wide_sums = np.array([spread[int(h)] for h in wide]).reshape(-1, width)
    held = docs.sparkSession.sparkContext.broadcast((wide, wide_sums))
    answers = asked.unionByName(pairs.where("block is not null").select(*asked.columns))
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        for block, got, _ in _opened(given, word_buckets, model.texts):
            scores = block_scores(block, got, model, kept, held.value, pair_buckets, hot)
            starts = np.cumsum(block.lengths) - block.lengths
            tokens = true_tokens
            base = np.log10((block.counts + 0.1) / (tokens + 0.1 * (model.types + 1)))
            columns = (np.add.reduceat(v, starts) for v in ((block.counts > 0).astype(np.int64), base, scores))
            for key, learned, n, *values in zip(block.keys, block.learned.tolist(), block.lengths.tolist(), *columns):
                yield (key, learned, n, int(values[0]), tokens, float(values[1]), float(values[2]))

    true_tokens = got[0]
    schema = (
        f"`{id_col}` {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double"
    )
    return map_rows(_with_answers(blocks, answers, BLOCK_COLUMNS), schema, rows)
