"""One-permutation MinHash fingerprints in DataFrame functions alone.

Shingles of five words are hashed once. The high bits of a hash name its bin, and each bin keeps its smallest hash: in
the sorted hashes that is the first of each bin. An empty bin takes the value of the occupied bin that comes first in
the empty bin's own random order, which is what probing by a universal hash until an occupied bin is met gives. The low
four bits of each bin are stored as one hexadecimal digit. Two unlike bins agree in one of 16 cases, which the likeness
corrects.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

SHINGLE = 5
BINS = 128
DIGITS = "0123456789abcdef"
#: Rows in one range of neighbours.
RANGE_ROWS = 2_048


def let(value: Column, use) -> Column:
    """Evaluate ``value`` once and apply ``use`` to it."""
    return F.transform(F.array(value), use).getItem(0)


def shingle_hashes(text: Column, words: int = SHINGLE) -> Column:
    """Sorted hashes of all runs of ``words`` words; fewer words are one run, none give an empty array."""

    def runs(hashes: Column) -> Column:
        whole = F.array(F.xxhash64(hashes))
        each = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - words),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(words)]),
        )
        none = F.array().cast("array<bigint>")
        return F.when(F.size(hashes) == 0, none).when(F.size(hashes) < words, whole).otherwise(each)

    parts = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")
    return F.sort_array(let(F.transform(parts, lambda w: F.xxhash64(w)), runs))


def fingerprint(text: Column, words: int = SHINGLE, bins: int = BINS) -> Column:
    """The fingerprint of a text: one digit for each bin, or an empty string for a text without words."""
    shift = 64 - (bins.bit_length() - 1)
    bin_of = lambda h: F.shiftrightunsigned(h, shift)

    def pack(smallest: Column) -> Column:
        return let(F.transform(smallest, lambda h: bin_of(h).cast("int")), lambda full: digits(smallest, full))

    def digits(smallest: Column, full: Column) -> Column:
        def taken(i: Column) -> Column:
            """The occupied bin that comes first in the order of the empty bin ``i``."""
            order = F.transform(
                full, lambda b: F.xxhash64(i, b).bitwiseAND(F.lit(-bins)).bitwiseOR(b.cast("long"))
            )
            return F.array_min(order).bitwiseAND(F.lit(bins - 1)).cast("int")

        def digit(i: Column) -> Column:
            at = F.array_position(full, i)
            found = F.when(at > 0, at).otherwise(F.array_position(full, taken(i))).cast("int")
            return F.substring(F.lit(DIGITS), F.get(smallest, found - 1).bitwiseAND(F.lit(15)).cast("int") + 1, 1)

        packed = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), digit), "")
        return F.when(F.size(full) == 0, F.lit("")).otherwise(packed)

    def firsts(hashes: Column) -> Column:
        return F.filter(hashes, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(hashes, i - 1))))

    return let(shingle_hashes(text, words), lambda hashes: let(firsts(hashes), pack))


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Estimated Jaccard similarity of two fingerprints, corrected for chance agreement of the low bits.

    Equal fingerprints have 1, also two empty ones; an empty and another one 0; null gives null.
    """
    same = F.size(
        F.filter(F.sequence(F.lit(1), F.lit(bins)), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1)))
    )
    chance = 1 / len(DIGITS)
    raw = (same / F.lit(float(bins)) - chance) / (1 - chance)
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), raw))


def with_next(df: DataFrame, key: str, ties: list[str], columns: dict[str, str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add columns of the next row by descending ``key``; the first row follows the last.

    ``columns`` maps new names to columns. Rows are cut into ranges of about ``range_rows`` keys, and the first row of
    each range is also sent to the range before it, so no window holds more. ``ties`` orders rows with one key; null
    keys come last.
    """
    span, ghost, to = (f"__{name}_{id(df):x}" for name in ("span", "ghost", "to"))
    order = F.coalesce(F.col(key).cast("double"), F.lit(float("-inf")))
    ranged = df.withColumn(to, order)
    rows = df.count()
    parts = max(1, -(-rows // range_rows))
    shares = [i / parts for i in range(1, parts)]
    known = ranged.where(F.col(to) > float("-inf"))
    cuts = known.approxQuantile(to, shares, 0.2 / parts) if shares else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if cuts:
        ranged = Bucketizer(splits=splits, inputCol=to, outputCol=span).transform(ranged)
        ranged = ranged.withColumn(span, F.col(span).cast("int"))
    else:
        ranged = ranged.withColumn(span, F.lit(0))
    heads = ranged.groupBy(span).agg(F.max(to).alias(ghost))  # one row a range
    before = F.lead(span).over(Window.orderBy(span))
    heads = heads.select(
        F.col(span).alias("s"), F.col(ghost).alias("h"),
        F.coalesce(before, F.min(span).over(Window.partitionBy())).alias("t"),
    )
    sent = ranged.join(F.broadcast(heads), F.col(span) == F.col("s"))
    places = F.array(F.struct(F.col(span).alias("s"), F.lit(False).alias("g")))
    ghosts = F.array(F.struct(F.col("t").alias("s"), F.lit(True).alias("g")))
    place = F.explode(F.when(F.col(to) == F.col("h"), F.concat(places, ghosts)).otherwise(places))
    sent = sent.select(*[F.col(f"`{c}`") for c in df.columns], place.alias("__place"))
    window = Window.partitionBy("__place.s").orderBy(
        F.col("__place.g"), F.col(key).desc_nulls_last(), *[F.col(t) for t in ties]
    )
    led = sent.select("*", *[F.lead(c).over(window).alias(name) for name, c in columns.items()])
    return led.where(~F.col("__place.g")).drop("__place")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is the start of the next document.

    Null texts are empty; rows with one id are ordered by their text; a single row is its own next. Other columns are
    not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("body"), fingerprint(text).alias("fingerprint"))
    led = with_next(base, id_col, ["body"], {"next_body": "body", "next_print": "fingerprint"})
    size = F.length("body")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(
        F.substr("body", F.lit(1), size - half), F.substr("next_body", F.lit(1), half)
    )
    out = led.select(
        F.col(id_col), size.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_print"
    )
    out = out.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return out.select(
        F.col(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )
