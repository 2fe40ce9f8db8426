"""Language identification: known words first, shorter and shorter character n-grams for the others.

A word or n-gram is known if it occurs in a training text, and has the counts of all languages; only what no training
text has is unknown. An unknown word is scored by its longest n-grams of which any is known. All counts stay in a table.
What makes up at least ``share`` of some language is also sent to every task, at most 5 / share entries a language; the
other words of the texts are looked up by joins. So ``share`` moves work, and changes no result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from .common import MEMO, keep, map_rows, stage

#: Letters, and the marks that belong to them; and the same for lower-case texts without characters beyond Latin ones.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
LATIN_LETTERS = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f]+")
BEYOND_LATIN = re.compile("[^\0-\u024f]")
SHARE = 2e-6
ORDERS = (4, 3, 2, 1)
#: Languages that a model may have; more are taken for a wrong label column.
MOST_LANGUAGES = 500
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Runs of letters, with the marks behind them, in lower case."""
    text = (text or "").lower()
    return (LETTERS if BEYOND_LATIN.search(text) else LATIN_LETTERS).findall(text)


def grams(word: str, n: int) -> list[str]:
    """N-grams of a word between two marks."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def _counts(given: Iterator[tuple], split) -> Iterator[tuple]:
    """Sum (language, word, n) over a partition, given away whenever the sums are many."""
    held: dict[str, Counter] = {}
    for language, part, n in given:
        counter = held.setdefault(language, Counter())
        split(counter, part, n)
        if sum(map(len, held.values())) >= MEMO:
            yield from ((lang, key, m) for lang, c in held.items() for key, m in c.items())
            held = {}
    yield from ((lang, key, m) for lang, c in held.items() for key, m in c.items())


def _add_words(counter: Counter, text: str, _: int) -> None:
    counter.update(words_of(text))


def _add_grams(counter: Counter, word: str, n: int) -> None:
    for order in ORDERS:
        for gram in grams(word, order):
            counter[f"{order}{gram}"] += n


class Model:
    """Log frequencies of the frequent words and n-grams by language, and what gives those of the others."""

    def __init__(
        self, languages: list[str], prior: np.ndarray, totals: dict[str, np.ndarray], entries: dict[str, np.ndarray]
    ):
        self.languages, self.prior, self.totals, self.entries = languages, prior, totals, entries
        self.place = {lang: i for i, lang in enumerate(languages)}
        self.floor = {order: np.log(0.5 / (total + 1)) for order, total in totals.items()}
        self.rows: dict[str, int] = {}
        self.matrix = np.zeros((1024, len(languages)))
        #: All counts (``part``, ``counts`` of each language that has it); on the driver only.
        self.counts: DataFrame | None = None

    def vector(self, part: str, counts: list) -> np.ndarray:
        """Log frequencies of a word or n-gram from its counts."""
        found = self.floor[part[0]].copy()
        for lang, n in counts:
            at = self.place[lang]
            found[at] = np.log(n / (self.totals[part[0]][at] + 1))
        return found.astype(np.float32)

    def unsettled(self, word: str) -> list[str]:
        """N-grams of an unknown word that must be looked up: down to the order of which a frequent one is known."""
        asked: dict[str, None] = {}
        for order in ORDERS:
            parts = [f"{order}{g}" for g in grams(word, order)]
            asked.update((p, None) for p in parts if p not in self.entries)
            if any(p in self.entries for p in parts):
                break
        return list(asked)

    def backed_off(self, word: str, looked_up: dict[str, np.ndarray]) -> np.ndarray:
        """The mean over the longest n-grams of an unknown word of which any is known."""
        for order in ORDERS:
            parts = (f"{order}{g}" for g in grams(word, order))
            found = (self.entries.get(p, looked_up.get(p)) for p in parts)
            known = [v for v in found if v is not None]
            if known:
                return np.mean(known, axis=0, dtype=np.float64).astype(np.float32)
        return np.zeros(len(self.languages), np.float32)

    def row(self, word: str) -> int:
        """The place of a frequent word's vector in the matrix; -1 for other words."""
        at = self.rows.get(word)
        if at is None:
            if len(self.rows) >= MEMO:
                self.rows = {}
            found = self.entries.get(f"0{word}")
            if found is None:
                return -1
            at = self.rows[word] = len(self.rows)
            if at >= len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            self.matrix[at] = found
        return at

    def frequent_part(self, text: str | None) -> tuple[bool, np.ndarray, Counter]:
        """Whether there is a word to judge, the sum over the prior and frequent words, and the other words."""
        words, total, others = words_of(text), self.prior.copy(), Counter()
        if not words or not self.languages:
            return False, total, others
        for i in range(0, len(words), 1 << 16):
            part = words[i : i + (1 << 16)]
            if len(self.rows) + (1 << 16) > MEMO:
                self.rows = {}
            rows = np.fromiter(map(self.row, part), np.int64, len(part))
            total += self.matrix[rows[rows >= 0]].sum(axis=0)
            others.update(part[j] for j in np.flatnonzero(rows < 0).tolist())
        return True, total, others

    def answer(self, total: np.ndarray) -> tuple[str, float]:
        """Language and its posterior from log probabilities."""
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def fit_language_model(
    docs: DataFrame, folder: str, text_col: str = "text", lang_col: str = "lang", share: float = SHARE
) -> Model:
    """Count words and n-grams of all texts with a language. The counts go to the shared folder, for the predictions.

    Rows without text or language teach nothing; an empty table gives a model without languages.
    """
    given = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.lit(1).alias("n"))
    given = given.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    schema = "lang string, part string, n long"
    add = lambda df, split: (
        map_rows(df, schema, lambda rows: _counts(rows, split), 1 << 15).groupBy("lang", "part").agg(F.sum("n").alias("n"))
    )
    word_counts = stage(add(given, _add_words), folder, "words")
    gram_counts = add(word_counts.select("lang", "part", "n"), _add_grams)
    both = word_counts.withColumn("part", F.concat(F.lit("0"), "part")).unionByName(gram_counts)
    both = stage(both.withColumn("order", F.substring("part", 1, 1)), folder, "entries")
    totals = both.groupBy("lang", "order").agg(F.sum("n").alias("total"))
    sums = {(r["lang"], r["order"]): r["total"] for r in totals.limit(MOST_LANGUAGES * 5 + 1).collect()}
    languages = sorted({lang for lang, _ in sums})
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values.")
    order_totals = {order: np.array([sums.get((lang, order), 0) for lang in languages], float) for order in "01234"}
    words = order_totals["0"]
    prior = np.log((words + 1) / (words + 1).sum()) if languages else words
    entries: dict[str, np.ndarray] = {}
    model = Model(languages, prior, order_totals, entries)
    often = F.max(F.col("n") >= share * F.col("total")).alias("often")
    counts = both.join(F.broadcast(totals), ["lang", "order"]).groupBy("part")
    model.counts = keep(counts.agg(F.collect_list(F.struct("lang", "n")).alias("counts"), often))
    for part, found in model.counts.where("often").select("part", "counts").toLocalIterator():
        entries[part] = model.vector(part, found)  # at most 5 / share entries a language
    return model


_HELD: dict[str, tuple] = {}


def _worker_model(value: tuple) -> Model:
    """The model of a broadcast value; a Python worker keeps the last one from task to task."""
    if "model" not in _HELD or _HELD["model"][0] is not value:
        languages, prior, totals, keys, vectors = value
        _HELD["model"] = (value, Model(languages, prior, totals, dict(zip(keys, vectors))))
    return _HELD["model"][1]


def _other_vectors(words: DataFrame, model: Model, held) -> DataFrame:
    """``word`` and its ``vector``, for distinct words that are not frequent: by its own counts, else by its n-grams."""
    known = model.counts.where(~F.col("often")).select("part", "counts")
    asked = words.withColumn("part", F.concat(F.lit("0"), "word")).join(known, "part", "left")

    def settle(given: Iterator[tuple]) -> Iterator[tuple]:
        own = _worker_model(held.value)
        for word, counts in given:
            asks = own.unsettled(word) if counts is None else []
            if counts is not None:
                yield word, own.vector("0", [(c["lang"], c["n"]) for c in counts]), asks
            else:
                yield word, None if asks else own.backed_off(word, {}), asks

    first = keep(
        map_rows(asked.select("word", "counts"), "word string, vector array<float>, asks array<string>", settle)
    )
    open_ = first.where("vector is null")
    answers = open_.select("word", F.explode("asks").alias("part")).join(known, "part")
    answers = answers.groupBy(F.col("word").alias("w")).agg(F.collect_list(F.struct("part", "counts")).alias("found"))

    def back_off(given: Iterator[tuple]) -> Iterator[tuple]:
        own = _worker_model(held.value)
        for word, found in given:
            parts = {f["part"]: own.vector(f["part"], [(c["lang"], c["n"]) for c in f["counts"]]) for f in found or ()}
            yield word, own.backed_off(word, parts)

    open_ = open_.join(answers, F.col("word") == F.col("w"), "left").select("word", "found")
    settled = first.where("vector is not null").select("word", "vector")
    return settled.unionByName(map_rows(open_, "word string, vector array<float>", back_off))


def predict_language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` of every text.

    Null texts and texts without a letter are ``und`` with score 0; of equally likely languages the first by name is
    taken; repeated rows are answered each; other columns are not read. Frequent words are summed where the rows lie;
    each text's other words meet their vectors in joins, and are added in the order of the words.
    """
    held = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.prior, model.totals, list(model.entries), np.array(list(model.entries.values()), np.float32))
    )

    def frequent(given: Iterator[tuple]) -> Iterator[tuple]:
        own = _worker_model(held.value)
        for row, key, text in given:
            any_word, total, others = own.frequent_part(text)
            yield row, key, any_word, total, list(others), list(others.values())

    def finish(given: Iterator[tuple]) -> Iterator[tuple]:
        own = _worker_model(held.value)
        for key, any_word, total, numbers, flat in given:
            if not any_word:
                yield key, UNKNOWN, 0.0
                continue
            total = np.array(total, np.float64)
            if numbers:
                total += np.array(numbers, np.float64) @ np.array(flat, np.float64).reshape(len(numbers), -1)
            yield (key, *own.answer(total))

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col))
    schema = f"row long, key {kind}, any_word boolean, total array<double>, words array<string>, counts array<long>"
    partial = keep(map_rows(given, schema, frequent, 1024))
    pairs = partial.select("row", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))).alias("o"))
    pairs = pairs.select("row", "o.word", "o.n")
    vectors = _other_vectors(pairs.select("word").distinct(), model, held).withColumnRenamed("word", "w")
    others = pairs.join(vectors, F.col("word") == F.col("w")).groupBy(F.col("row").alias("r"))
    others = others.agg(F.sort_array(F.collect_list(F.struct("word", "n", "vector"))).alias("others"))
    flat = F.flatten(F.transform("others", lambda o: o["vector"])).alias("flat")
    whole = partial.join(others, F.col("row") == F.col("r"), "left")
    return map_rows(
        whole.select("key", "any_word", "total", F.col("others.n").alias("n"), flat),
        f"`{id_col}` {kind}, lang_pred string, score double",
        finish,
        1024,
    )
