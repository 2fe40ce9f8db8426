"""Token counts by a finite-state tokenizer: BPE as a deterministic transducer, chunk maps composed by a prefix scan.

Compilation. For merges in rank order, the encoding of a word's prefix is the encoding of a shorter prefix plus one
token, and a token sequence is the encoding of its text exactly if each pair of neighbours is. So a prefix is summed up
by the places where a longer token can still begin: the pending symbols, the token before them, and how many tokens lie
before. Those are the states; reading a symbol leads to one next state and emits a (signed) number of tokens. States
and transitions are compiled when first met, as in lazy automata for patterns, and kept up to a bound.

Scan. White space brings every state back to the start, so the map of a chunk is constant behind its first white space.
It is held as (head, closed, emitted, tail): symbols before the first white space, whether there is one, tokens emitted
between, symbols behind the last one. Two maps compose to one, associatively; a balanced scan gives the count before
each chunk and the total.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from .common import MEMO, map_rows

#: Code points in a chunk.
CHUNK = 1 << 15
#: States kept by a compiled automaton.
STATES = 1 << 18
#: Python also parts words at these, which are no white space to Unicode.
ODD_SPACE = re.compile("[\x1c-\x1f]")
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Longest run that is remembered: bounds a memo in bytes.
SHORT = 64
#: A word of Latin-1 letters and ASCII marks: two pieces, stable under every normal form.
PLAIN_WORD = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@\\[-`{-~]*)")


class Transducer:
    """A BPE model with word ends as a lazily compiled deterministic transducer over the symbols of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.tokens = set(model["vocab"])
        ends = len(self.end)
        self.begins = {
            bare[:i]
            for token in self.tokens
            for bare in [token[:-ends] if ends and token.endswith(self.end) else token]
            for i in range(1, len(bare) + 1)
        }
        self.fits: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget the compiled states; state 0 is the start."""
        self.states = {((("", "", 0),)): 0}
        self.known = [((("", "", 0),))]
        self.step: dict[tuple[int, str], tuple[int, int]] = {}
        self.last: dict[tuple[int, str], int] = {}

    def symbols(self, token: str) -> list[str]:
        """The characters of a token, the last one with the word end if the token has it."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            bare = token[: -len(self.end)]
            return [*bare[:-1], bare[-1] + self.end]
        return list(token)

    def encode(self, parts: list[str]) -> list[str]:
        """Merge by rank, the leftmost first."""
        while len(parts) > 1:
            rank, at = min((self.rank.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            a, b = parts[at], parts[at + 1]
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                    merged.append(a + b)
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def fit(self, a: str, b: str) -> bool:
        """Whether token ``b`` can follow ``a`` (empty: the start) in an encoding."""
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) >= MEMO:
                self.fits.clear()
            found = self.encode((self.symbols(a) if a else []) + self.symbols(b)) == ([a, b] if a else [b])
            self.fits[(a, b)] = found
        return found

    def _token(self, state: int, symbol: str, end: str) -> tuple[str, int]:
        for pending, before, emitted in self.known[state]:
            token = pending + symbol + end
            if token in self.tokens and self.fit(before, token):
                return token, emitted + 1
        raise ValueError(f"No token ends in {symbol!r}; the vocabulary lacks it as a symbol.")

    def next(self, state: int, symbol: str) -> tuple[int, int]:
        """The state after an inner symbol of a word and the tokens that it emits."""
        token, delta = self._token(state, symbol, "")
        places = [
            (pending + symbol, before, emitted - delta)
            for pending, before, emitted in self.known[state]
            if pending + symbol in self.begins
        ]
        key = (*places, ("", token, 0))
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = len(self.known)
            self.known.append(key)
        return to, delta

    def count(self, word: str) -> int:
        """Tokens that the transducer emits over a word, from the start to its end."""
        if len(self.known) > STATES:
            self.reset()
        state = emitted = 0
        for symbol in word[:-1]:
            move = self.step.get((state, symbol))
            if move is None:
                move = self.step[(state, symbol)] = self.next(state, symbol)
            state, delta = move
            emitted += delta
        end = self.last.get((state, word[-1]))
        if end is None:
            end = self.last[(state, word[-1])] = self._token(state, word[-1], self.end)[1]
        return emitted + end


class ChunkMap(NamedTuple):
    """What a chunk does to the tokenizer's state, see the module's text."""

    head: str
    closed: bool
    emitted: int
    tail: str


PLAIN_LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100))]


def lowers_plain_words(tokenizer) -> bool:
    """Whether a tokenizer puts Latin-1 letters in lower case and parts them from marks."""
    if not tokenizer.normalizer:
        return False
    upper = [c.upper() if len(c.upper()) == 1 and c.upper() <= "\xff" else c for c in PLAIN_LETTERS]
    lower = [tokenizer.normalizer.normalize_str(u + "!") for u in upper]
    pieces = tokenizer.pre_tokenizer.pre_tokenize_str
    return all(low == c + "!" and len(pieces(low)) == 2 for c, low in zip(PLAIN_LETTERS, lower))


@lru_cache(maxsize=4)
def token_counter(path: str) -> TokenCounter:
    """The counter of a file; a Python worker keeps it from task to task."""
    return TokenCounter(path)


class TokenCounter:
    """Chunk maps and counts for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.pieces = tokenizer.pre_tokenizer.pre_tokenize_str
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.transducer = Transducer(path)
        self.alphabet = {ord(c): self.pieces(c)[0][0] for c in PLAIN_LETTERS}
        self.lowers = lowers_plain_words(tokenizer)
        self.words: dict[str, int] = {}
        self.counts: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        """Tokens of one pre-tokenized piece."""
        found = self.counts.get(piece)
        if found is None:
            if len(self.counts) >= MEMO:
                self.counts.clear()
            found = self.transducer.count(piece)
            if len(piece) <= SHORT:
                self.counts[piece] = found
        return found

    def run(self, text: str) -> int:
        """Tokens of symbols without white space, from the start state back to it."""
        found = self.words.get(text)
        if found is None:
            if len(self.words) >= MEMO:
                self.words.clear()
            plain = PLAIN_WORD.fullmatch(text) if self.lowers else None
            if plain:
                found = self.piece(plain[1].lower().translate(self.alphabet)) + (self.piece(plain[2]) if plain[2] else 0)
            else:
                found = self._run(text)
            if len(text) <= SHORT:
                self.words[text] = found
        return found

    def _run(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return len(parts) // 2 + sum(
            self.piece(piece)
            for part in parts[::2]
            if part
            for piece, _ in self.pieces(self.normalize(part))
            if piece
        )

    def chunk(self, text: str) -> ChunkMap:
        """The map of one chunk."""
        first = SPACE.search(text)
        if first is None:
            return ChunkMap(text, False, 0, "")
        head = text[: first.start()]
        if ODD_SPACE.search(text):
            words = SPACE.split(text[first.end() :])
            tail = words.pop()
            words = [w for w in words if w]
        else:
            words = text[first.end() :].split()
            tail = "" if not words or SPACE.match(text[-1]) else words.pop()
        return ChunkMap(head, True, sum(map(self.run, words)), tail)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First ``a``, then ``b``."""
        if not a.closed:
            return b._replace(head=a.head + b.head)
        if not b.closed:
            return a._replace(tail=a.tail + b.head)
        between = a.tail + b.head
        return ChunkMap(a.head, True, a.emitted + b.emitted + (self.run(between) if between else 0), b.tail)

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Inclusive prefix scan: pairs compose, their scan is filled up to all."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])])
        out = maps[:1]
        for i in range(1, len(maps)):
            out.append(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]))
        return out

    def total(self, done: ChunkMap) -> int:
        """Tokens when the input ends behind a map applied to the start state."""
        if not done.closed:
            return self.run(done.head) if done.head else 0
        return done.emitted + sum(self.run(x) for x in (done.head, done.tail) if x)

    def offsets(self, text: str, size: int = CHUNK) -> list[int]:
        """Tokens of the text up to the end of each chunk; the last one is the whole text's count."""
        chunks = [self.chunk(text[i : i + size]) for i in range(0, len(text), size)]
        return [self.total(done) for done in self.scan(chunks)] or [0]


def count_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, chunk: int = CHUNK
) -> DataFrame:
    """Token count of every text: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit``, ``chunk_tokens``.

    One row per input row, in one pass without a shuffle. A null text is empty and has 0 tokens and [0] as
    ``chunk_tokens``, the counts up to the end of each chunk of ``chunk`` code points. A null id stays null, repeated
    rows are counted each, other columns are not read. ``tokenizer`` is a path that every executor has.
    """

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        counter = token_counter(tokenizer)
        for key, size, text in given:
            upto = counter.offsets(text, chunk)
            yield key, size, upto[-1], upto[-1] > limit, upto

    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("size"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        given, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean, chunk_tokens array<long>", rows
    )
