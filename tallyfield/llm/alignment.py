"""Alignment of two tokenizers over the same bytes, by galloping intersection of their token ends.

Both tokenizers cut a space and the text into tokens; the byte offsets where a token ends are two increasing lists. The
shorter list drives: each of its ends is looked for in the longer one by steps that double until they pass it, then by
halving. Heads of blocks of ends are searched for first; then all ends gallop from where their head was found, side by
side. Ends in both lists cut the tokens into groups; differences of the
ranks of neighbouring common ends are the ranges of tokens that overlap.

Links are the pairs of ids in one group. How many documents hold a pair is counted over the corpus: rows are packed in
blocks of bounded size, which send their distinct pairs once, and get the counts of these pairs back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_rows, stage

#: Keys in a block whose head is searched for first.
HEADS = 8
#: Tokens of the first tokenizer in a block of documents.
BLOCK_TOKENS = 1 << 22
#: Links of groups that are unfolded at a time.
LINKS = 1 << 20
#: Characters of texts that are aligned side by side.
TEXTS = 1 << 19
#: Characters whose classes no library's tables disagree on.
_PLAIN = re.compile("[\t\n\r -~\xa1-\u024f\u2010-\u2027]*")


def gallop(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each key has its first end that is not smaller; both increase, and the last end is not below the last key.

    Keys start where the head of their block was found, which is searched for first, in the same way.
    """
    low = np.repeat(gallop(keys[::HEADS], ends), HEADS)[: len(keys)] if len(keys) > 1 else np.zeros(1, np.int64)
    high, step, last = low, 1, len(ends) - 1
    behind = np.flatnonzero(ends[high] < keys)
    low, high = low.copy(), high.copy()
    while len(behind):
        low[behind] = high[behind] + 1
        high[behind] = np.minimum(high[behind] + step, last)
        behind = behind[ends[high[behind]] < keys[behind]]
        step *= 2
    wide = np.flatnonzero(low < high)
    while len(wide):
        middle = (low[wide] + high[wide]) // 2
        below = ends[middle] < keys[wide]
        low[wide[below]] = middle[below] + 1
        high[wide[~below]] = middle[~below]
        wide = wide[low[wide] < high[wide]]
    return low


def common_ranks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in two increasing lists of the values that both have; the lists end alike."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not len(short):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = gallop(short, long)
    mine = np.flatnonzero(long[found] == short)
    return (mine, found[mine]) if short is a else (found[mine], mine)


def _byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in set(own)]
    return {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(rest)}


class ByteTokens:
    """Byte-level BPE of a tokenizer file; special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        symbols = _byte_symbols()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        texts = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = [bytes(symbols[c] for c in t) if all(c in symbols for c in t) else t.encode() for t in texts]
        self.fast = self._ranked(path, symbols)

    def _ranked(self, path: str, symbols: dict[str, int]):
        """The same vocabulary by ranks, if ids follow the order of merges and words are cut by the usual pattern."""
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        in_order = all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if not (in_order and usual and spec.get("normalizer") is None):
            return None
        ranks = {bytes(symbols[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(merges)}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def same(self, ids: list[int], whole: bytes) -> bool:
        """Whether tokens give back the bytes; without a normalizer that holds by their making."""
        return self.fast is not None or b"".join(map(self.bytes.__getitem__, ids)) == whole

    def encode(self, text: str) -> list[int]:
        """Ids of a space and a text."""
        if self.fast is not None and _PLAIN.fullmatch(text):
            return self.fast.encode_ordinary(" " + text)
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids


class PieceTokens:
    """Pieces of a model that puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]

    def same(self, ids: list[int], whole: bytes) -> bool:
        """Whether tokens give back the bytes."""
        return b"".join(map(self.bytes.__getitem__, ids)) == whole


_NONE = np.zeros(0, np.int64)


class Groups(NamedTuple):
    """Ids of some texts one after another, how many of them each group takes, and the number of each group's text."""

    a: np.ndarray
    b: np.ndarray
    in_a: np.ndarray
    in_b: np.ndarray
    text: np.ndarray


class Aligner:
    """Tokens and groups of texts by two tokenizer files."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        width = max(map(len, self.sizes))
        self.written = np.array([b"%d%c" % (i, mark) for i in range(width) for mark in b",|;"])

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers; none if a text is empty or the bytes of its tokens differ from a space and the text."""
        out = []
        for text, b in zip(texts, self.b.model.encode([t or "" for t in texts], num_threads=1)):
            a, whole = self.a.encode(text) if text else [], b" " + (text or "").encode()
            if text and not (self.a.same(a, whole) and self.b.same(b, whole)):
                text = ""
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if text else (_NONE, _NONE))
        return out

    def groups(self, found: list[tuple[np.ndarray, np.ndarray]]) -> Groups:
        """The groups of all texts, side by side: both lists of ends go on from text to text, and texts end in both."""
        a, b = (np.concatenate([pair[i] for pair in found]) for i in (0, 1))
        ranks = common_ranks(np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b]))
        in_a, in_b = (np.diff(x, prepend=-1) for x in ranks)
        text = np.searchsorted(np.cumsum([len(pair[0]) for pair in found]), ranks[0] + 1)
        return Groups(a, b, in_a, in_b, text)

    def digests(self, found: list[tuple[np.ndarray, np.ndarray]], all_: Groups) -> list[str]:
        """SHA-256 of each text's groups as text; '' without tokens."""
        ends_a, ends_b = np.cumsum(all_.in_a), np.cumsum(all_.in_b)
        out = np.empty(len(all_.a) + len(all_.b), np.int64)
        marks = np.zeros(len(all_.a), np.int64)
        marks[ends_a - 1] = 1
        out[np.arange(len(all_.a)) + np.repeat(ends_b - all_.in_b, all_.in_a)] = 3 * all_.a + marks
        marks = np.zeros(len(all_.b), np.int64)
        marks[ends_b - 1] = 2
        out[np.arange(len(all_.b)) + np.repeat(ends_a, all_.in_b)] = 3 * all_.b + marks
        done, at = [], 0
        for a, b in found:
            size = len(a) + len(b)
            text = self.written[out[at : at + size]].tobytes().replace(b"\0", b"")  # numbers have one width, filled up
            done.append(hashlib.sha256(text[:-1]).hexdigest() if size else "")
            at += size
        return done


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of two files; a Python worker keeps it from task to task."""
    return Aligner(path_a, path_b)


def pair_counts(all_: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids that share a group, by text: the text's number, ``a << 32 | b``, and how many links it has."""
    a, b, in_a, in_b, text = all_
    starts_a, starts_b, links = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b, in_a * in_b
    wide_a, wide_b = (int(x.max(initial=0)) + 1 for x in (a, b))
    parts = []
    for g in np.flatnonzero(links > LINKS).tolist():
        (ids_a, times_a), (ids_b, times_b) = (
            np.unique(x[s[g] : s[g] + n[g]], return_counts=True) for x, s, n in ((a, starts_a, in_a), (b, starts_b, in_b))
        )
        rows = max(1, LINKS // len(ids_b))
        for i in range(0, len(ids_a), rows):
            codes = ((text[g] * wide_a + ids_a[i : i + rows, None]) * wide_b + ids_b).ravel()
            parts.append((codes, (times_a[i : i + rows, None] * times_b).ravel()))
    small = np.flatnonzero(links <= LINKS)
    for part in np.split(small, np.flatnonzero(np.diff(np.cumsum(links[small]) // LINKS)) + 1):
        each = links[part]
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        wide = np.repeat(in_b[part], each)
        left = a[np.repeat(starts_a[part], each) + nth // wide]
        right = b[np.repeat(starts_b[part], each) + nth % wide]
        parts.append(np.unique((np.repeat(text[part], each) * wide_a + left) * wide_b + right, return_counts=True))
    codes, times = parts[0]
    if len(parts) > 1:
        codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        times = np.zeros(len(codes), np.int64)
        np.add.at(times, back, np.concatenate([p[1] for p in parts]))
    rest, right = np.divmod(codes, wide_b)
    text, left = np.divmod(rest, wide_a)
    return text, left << 32 | right, times


def _batches(given: Iterator[tuple], most: int = TEXTS) -> Iterator[list[tuple]]:
    """Rows of a key and a text, in lists of bounded length."""
    held, size = [], 0
    for row in given:
        held.append(row)
        size += len(row[1] or "") + 64
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_groups(
    docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of both tokenizers and their groups: ``id_col``, ``a_ids``, ``b_ids``, ``a_in_group``, ``b_in_group``.

    One row per input row, without a shuffle. ``a_in_group`` and ``b_in_group`` are how many tokens each group takes
    from either list, in order. Texts that are null or empty, or that a tokenizer does not give back byte by byte, have
    empty lists. Other columns are not read; an empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        both = aligner(tokenizer_a, tokenizer_b)
        for batch in _batches(given):
            found = both.tokens([text for _, text in batch])
            groups = both.groups(found)
            cuts = np.searchsorted(groups.text, np.arange(1, len(batch)))
            for (key, _), ids, *sizes in zip(batch, found, np.split(groups.in_a, cuts), np.split(groups.in_b, cuts)):
                yield key, *(x.astype(np.int32) for x in (*ids, *sizes))

    schema = f"`{id_col}` {kind}, a_ids array<int>, b_ids array<int>, a_in_group array<int>, b_in_group array<int>"
    return map_rows(docs.select(id_col, text_col), schema, rows, 256)


def _packed(at: np.ndarray, times: np.ndarray) -> bytes:
    """Increasing places and how often each counts, small."""
    return pa.compress(np.concatenate((np.diff(at, prepend=0), times)).astype("<u4").tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    values = np.frombuffer(pa.decompress(data, 8 * size, "zstd", asbytes=True), "<u4").astype(np.int64)
    return np.cumsum(values[:size]), values[size:]


def alignment(
    docs: DataFrame,
    tokenizer_a: str,
    tokenizer_b: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """How two tokenizers align over every text, and how usual its links are in the corpus.

    Returns per input row ``id_col``, ``n_a`` and ``n_b`` (tokens), ``n_groups``, ``n_links`` (token pairs that share a
    group), ``n_best`` (links whose id pair stands in as many documents as any pair of its first id), ``count_sum``
    (documents of the pair, over links) and ``groups_sha256``. Texts that are null or empty, or that a tokenizer does
    not give back byte by byte, have zeros and ''. Each row is a document, repeated rows too; a null id stays null. Ties
    for the highest count all count. Other columns are not read; an empty table gives an empty table. ``folder`` takes
    the staged tables, ``block_tokens`` bounds a block.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, sha string, size int, links binary"
    fields = ["key", "n_a", "n_b", "n_groups", "n_links", "sha", "size", "links"]

    def blocks(given: Iterator[tuple]) -> Iterator[tuple]:
        both = aligner(tokenizer_a, tokenizer_b)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        tokens = 0
        for batch in _batches(given, min(TEXTS, block_tokens)):
            found = both.tokens([text for _, text in batch])
            groups = both.groups(found)
            n_groups = np.bincount(groups.text, minlength=len(batch)).tolist()
            n_links = np.bincount(groups.text, groups.in_a * groups.in_b, len(batch)).tolist()
            text, pairs, times = pair_counts(groups)
            cuts = np.searchsorted(text, np.arange(1, len(batch)))
            rows = zip(batch, found, n_groups, n_links, both.digests(found, groups), np.split(pairs, cuts), np.split(times, cuts))
            for (key, _), (a, b), n, links, sha, own, counts in rows:
                held.append(((key, len(a), len(b), n, int(links), sha), own, counts))
            tokens += len(groups.a)
            if tokens >= block_tokens:
                yield from block(number, held)
                number, held, tokens = number + 1, [], 0
        if held:
            yield from block(number, held)

    def block(number: int, held: list[tuple]) -> Iterator[tuple]:
        pairs, n = np.unique(np.concatenate([p for _, p, _ in held]), return_counts=True)
        yield (number, *[None] * len(fields), pairs, n.astype(np.int32))
        while held:
            row, own, times = held.pop()
            yield (number, *row, len(own), _packed(np.searchsorted(pairs, own), times), None, None)

    given = map_rows(docs.select(id_col, text_col), f"block long, {schema}, pairs array<long>, n array<int>", blocks, 256)
    given = stage(given, folder, "blocks")
    flat = given.where("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "n")).alias("p"))
    flat = flat.select("block", F.col("p.pairs").alias("pair"), F.col("p.n").alias("n"))
    counts = stage(flat.groupBy("pair").agg(F.sum("n").alias("docs")), folder, "counts")
    first = Window.partitionBy(F.shiftright("pair", 32))  # at most as many rows as the second vocabulary has ids
    counts = counts.withColumn("best", F.col("docs") == F.max("docs").over(first))
    counts = stage(counts, folder, "best")
    back = flat.select("block", "pair").join(counts, "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pair", "docs", "best"))).alias("found")
    )
    own = given.where("pairs is null").select("block", *fields)
    back = back.select("block", F.col("found.docs"), F.col("found.best"))
    both = own.unionByName(back, allowMissingColumns=True).withColumn("turn", F.col("docs").isNull())
    tasks = max(8, given.where("pairs is not null").count())
    both = both.repartition(tasks, "block").sortWithinPartitions("block", "turn")

    def scores(given: Iterator[tuple]) -> Iterator[tuple]:
        docs_of = best_of = np.zeros(0, np.int64)
        for _, key, n_a, n_b, n_groups, n_links, sha, size, links, docs, best, _ in given:
            if docs is not None:
                docs_of, best_of = np.array(docs, np.int64), np.array(best, np.int64)
                continue
            at, times = _unpacked(links, size)
            yield key, n_a, n_b, n_groups, n_links, int(best_of[at] @ times), int(docs_of[at] @ times), sha

    out = (
        f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    return map_rows(both, out, scores)
