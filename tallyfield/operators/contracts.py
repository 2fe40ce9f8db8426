"""Column contracts: headers, required columns, typed columns, validity flags, rejection, dedup."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from ..functions.labels import rejection_reason
from ..functions.parsing import parse_bool, parse_double, parse_int, parse_timestamp
from .scalars import MAX_BROADCAST_ROWS, at_least

#: Types whose minimum Spark keeps in place, so that it can aggregate by hash.
_FIXED_WIDTH = (BooleanType, DateType, NumericType, TimestampNTZType, TimestampType)
_PARSERS = {
    "int": lambda col: parse_int(col, "int"),
    "long": lambda col: parse_int(col, "long"),
    "double": parse_double,
    "boolean": parse_bool,
    "string": F.trim,
}


@dataclass(frozen=True)
class Flag:
    """A validity flag: every listed column lies within its inclusive bounds (None is unbounded)."""

    name: str
    bounds: Mapping[str, tuple[float | None, float | None]]


@dataclass(frozen=True)
class FactContract:
    """How raw text columns become a typed, flagged and deduplicated fact table."""

    name: str
    required: Collection[str]
    key: str
    timestamp: str
    timestamp_source: str
    timestamp_formats: Sequence[str]
    casts: Mapping[str, tuple[str, str]]
    texts: Mapping[str, str]
    flags: Sequence[Flag]
    reasons: Mapping[str, str]
    columns: Sequence[str]
    aliases: Mapping[str, str] = field(default_factory=dict)

    @property
    def mandatory(self) -> list[str]:
        """Flags a row must pass to be kept."""
        return list(self.reasons.values())


@dataclass(frozen=True)
class LookupContract:
    """How raw text columns become a small typed lookup with one row per key in range."""

    name: str
    key: str
    key_range: tuple[int, int]
    text: str
    measures: Sequence[str]
    aliases: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [self.key, self.text, *self.measures]


def normalize_columns(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename each known header variant that is present; other columns stay as they are."""
    names = [aliases.get(name, name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"Several headers stand for the same column: {', '.join(clashes)}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Collection[str], name: str) -> DataFrame:
    """Return ``df``, or fail with the sorted list of missing columns; no job runs."""
    missing = sorted(set(required).difference(df.columns))
    if missing:
        raise ValueError(f"{name} input is missing required columns: {', '.join(missing)}")
    return df


def cast_columns(df: DataFrame, casts: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add typed columns from ``{target: (source, type)}``; malformed text becomes NULL."""
    return df.withColumns({dst: _PARSERS[kind](F.col(f"`{src}`")) for dst, (src, kind) in casts.items()})


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    """Add year, month, hour and day_of_week (1 is Sunday) of a timestamp column."""
    col = F.col(ts)
    return df.withColumns(
        {"year": F.year(col), "month": F.month(col), "hour": F.hour(col), "day_of_week": F.dayofweek(col)}
    )


def _flag_column(flag: Flag) -> Column:
    checks = []
    for name, (low, high) in flag.bounds.items():
        checks.append(F.col(name).isNotNull())
        if low is not None:
            checks.append(F.col(name) >= low)
        if high is not None:
            checks.append(F.col(name) <= high)
    passed = checks[0]
    for check in checks[1:]:
        passed = passed & check
    return F.coalesce(passed, F.lit(False))


def add_flags(df: DataFrame, flags: Sequence[Flag]) -> DataFrame:
    """Add boolean validity flags that are never NULL; a missing value fails its flag."""
    return df.withColumns({flag.name: _flag_column(flag) for flag in flags})


def require_flags(df: DataFrame, flags: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Keep rows on which every flag is true and every listed column is present."""
    for name in flags:
        df = df.filter(F.col(name))
    return df.dropna(subset=list(not_null)) if not_null else df


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any listed column."""
    return df.dropna(subset=list(cols))


def keep_range(df: DataFrame, col: str, low: int, high: int) -> DataFrame:
    """Keep rows whose key lies in an inclusive range; NULL keys go."""
    return df.filter(F.col(col).between(low, high))


def reject(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Keep the rows that pass all mandatory flags."""
    return require_flags(df, flags)


def quarantine(df: DataFrame, reasons: Mapping[str, str]) -> DataFrame:
    """Rows that fail a mandatory flag, with the comma-joined reasons; ``reasons`` is {reason: flag}."""
    failed = F.lit(False)
    for flag in reasons.values():
        failed = failed | ~F.col(flag)
    return df.filter(failed).withColumn("rejection_reason", rejection_reason(reasons))


def _smallest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: a plain minimum of the other columns, so each map task sends one row per key.

    Spark aggregates such minima by sorting; this is for the rows of repeated keys and for small tables.
    """
    first = [c for c in order_by if c not in keys]
    rest = [c for c in columns if c not in keys and c not in first]
    row = F.struct(F.lit(True).alias("_any"), *[F.col(f"`{c}`") for c in [*first, *rest]])
    grouped = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(row).alias("_smallest"))
    return grouped.select(*[f"`{c}`" if c in keys else F.col("_smallest").getField(c).alias(c) for c in columns])


def repeated_keys(df: DataFrame, keys: Sequence[str], lead: str | None = None) -> DataFrame:
    """Keys that several rows share as ``_key_0``, ``_key_1`` and so on, and the least ``lead`` of each as ``_least``.

    A key without a lead in some row has NULL as its least one. Buffers have a fixed width, so Spark counts by hash.
    """
    named = [F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)]
    least = [] if lead is None else [F.min(lead).alias("_min"), F.count(lead).alias("_leads")]
    counts = df.groupBy(*named).agg(F.count("*").alias("_rows"), *least).filter("_rows > 1")
    if lead is None:
        return counts.drop("_rows")
    return counts.withColumn("_least", F.when(F.col("_leads") == F.col("_rows"), F.col("_min"))).drop(
        "_rows", "_leads", "_min"
    )


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    where: Column | None = None,
    columns: Sequence[str] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the remaining ``columns``; NULL is the smallest value.

    Keys are counted by hash, with partial counts in each map task, and rows whose key occurs once pass an anti join:
    they are never sorted. Of a repeated key only the rows with its least first ``order_by`` value, if that has a fixed
    width, are compared as a whole. The survivor does not depend on partitioning. ``where`` accepts rows.

    ``keep`` writes the table of repeated keys and reads it back. Few of them are then broadcast, and the other rows
    need no shuffle; otherwise both sides are hashed to partitions, where Spark splits a hot one.
    """
    columns = list(columns or df.columns)
    lead = next((c for c in order_by if c not in keys and isinstance(df.schema[c].dataType, _FIXED_WIDTH)), None)
    lead = lead if lead in order_by[:1] else None
    needed = [*columns, *[c for c in [*keys, *order_by] if c not in columns]]
    rows = (df if where is None else df.filter(where)).select(*[f"`{c}`" for c in dict.fromkeys(needed)])
    repeated = repeated_keys(rows, keys, lead)
    few = False
    if keep is not None:
        repeated = keep(repeated)
        few = not at_least(repeated, MAX_BROADCAST_ROWS + 1)
    repeated = F.broadcast(repeated) if few else repeated.hint("shuffle_hash")
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col(f"`{key}`").eqNullSafe(F.col(f"_key_{i}"))
    single = rows.join(repeated, same, "left_anti").select(*[f"`{c}`" for c in columns])
    if lead is not None:
        # Not an equality, or Spark would shuffle the rows by it once more.
        same = same & ((F.col(lead).isNull() & F.col("_least").isNull()) | (F.col(lead) <= F.col("_least")))
    tied = rows.join(repeated, same, "left_semi")
    return single.unionByName(_smallest(tied, keys, order_by, columns))


def project_contract(df: DataFrame, columns: Sequence[str], texts: Mapping[str, str]) -> DataFrame:
    """Fixed output columns in order; ``texts`` are trimmed, or NULL strings when their source is absent."""

    def output(name: str) -> Column:
        if name not in texts:
            return F.col(name)
        if texts[name] in df.columns:
            return F.trim(F.col(f"`{texts[name]}`")).alias(name)
        return F.lit(None).cast("string").alias(name)

    return df.select(*[output(name) for name in columns])


def prepare(raw: DataFrame, contract: FactContract) -> DataFrame:
    """Parse, cast, derive and flag; no row is rejected.

    Column names are case-insensitive, so a raw ``District`` would be lost to the typed ``district``.
    Such raw columns are kept as ``raw_district``.
    """
    raw = require_columns(normalize_columns(raw, contract.aliases), contract.required, contract.name)
    targets = {
        contract.timestamp,
        *contract.casts,
        *(flag.name for flag in contract.flags),
        "year",
        "month",
        "hour",
        "day_of_week",
    }
    lowered = {name.lower() for name in targets}
    renamed = {name: f"raw_{name.lower()}" for name in raw.columns if name.lower() in lowered}
    kept = raw.toDF(*[renamed.get(name, name) for name in raw.columns])
    casts = {dst: (renamed.get(src, src), kind) for dst, (src, kind) in contract.casts.items()}
    source = renamed.get(contract.timestamp_source, contract.timestamp_source)
    parsed = parse_timestamp(F.col(f"`{source}`"), contract.timestamp_formats)
    typed = cast_columns(kept.withColumn(contract.timestamp, parsed), casts)
    return add_flags(add_calendar(typed, contract.timestamp), contract.flags)


def blank_accepted_text(prepared: DataFrame, contract: FactContract) -> DataFrame:
    """Prepared rows whose raw text is NULL unless the row is rejected: nothing but the quarantine shows it.

    Texts that the contract takes over stay, and so do all of its columns and flags. Written rows are much shorter.
    """
    used = {*contract.columns, *contract.texts.values(), *contract.mandatory, *(flag.name for flag in contract.flags)}
    rejected = F.lit(False)
    for flag in contract.mandatory:
        rejected = rejected | ~F.col(flag)
    col = {name: F.col(f"`{name}`") for name in prepared.columns}
    return prepared.select(*[value if name in used else F.when(rejected, value).alias(name) for name, value in col.items()])


def _accepted(prepared: DataFrame, contract: FactContract) -> tuple[DataFrame, Column]:
    """Contract columns and mandatory flags, and the condition that all of these flags hold."""
    extra = [flag for flag in contract.mandatory if flag not in contract.columns]
    passed = F.col(contract.mandatory[0])
    for flag in contract.mandatory[1:]:
        passed = passed & F.col(flag)
    return project_contract(prepared, [*contract.columns, *extra], contract.texts), passed


def clean(
    prepared: DataFrame, contract: FactContract, keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Reject by the mandatory flags, keep one row per key, project the contract; ``keep`` as in ``dedup``."""
    projected, passed = _accepted(prepared, contract)
    return dedup(projected, [contract.key], [contract.timestamp], passed, contract.columns, keep)


def prepare_lookup(raw: DataFrame, contract: LookupContract) -> DataFrame:
    """Typed lookup with one row per key in range; total rows and NULL keys are removed."""
    named = require_columns(normalize_columns(raw, contract.aliases), contract.columns, contract.name)
    typed = named.select(
        parse_int(F.col(contract.key)).alias(contract.key),
        F.trim(F.col(contract.text)).alias(contract.text),
        *[parse_double(F.col(name)).alias(name) for name in contract.measures],
    )
    kept = keep_range(typed, contract.key, *contract.key_range)
    return _smallest(kept, [contract.key], [contract.text], kept.columns)


#: What parsing does to the text of each type.
_RULES = {
    "int": "whole part of a trimmed number",
    "long": "whole part of a trimmed number",
    "double": "trimmed number",
    "boolean": "trimmed word, upper or lower case",
    "string": "trimmed text",
}
_TYPES = {"int": "integer"}


def _policy(contract: FactContract, target: str) -> str:
    """What happens to rows whose value is missing or out of bounds, from the flags that test it."""
    for flag in contract.flags:
        if target not in flag.bounds:
            continue
        low, high = flag.bounds[target]
        bounds = [f"{what} {value:g}" for what, value in (("below", low), ("above", high)) if value is not None]
        wrong = " or ".join(["missing", *bounds])
        return f"row rejected if {wrong}" if flag.name in contract.mandatory else f"row kept, {flag.name} false if {wrong}"
    return "row kept"


def dictionary_rows(contract: FactContract) -> list[tuple[str, str, str, str, str]]:
    """One row per required source field: its target, type, cleaning rule and policy, all as the contract has them."""
    targets = {source: (target, kind) for target, (source, kind) in contract.casts.items()}
    targets |= {source: (target, "string") for target, source in contract.texts.items() if source not in targets}
    rows = []
    for source in contract.required:
        if source == contract.timestamp_source:
            target, kind = contract.timestamp, "timestamp"
            rule = "first format that fits: " + ", ".join(contract.timestamp_formats)
        else:
            target, kind = targets[source]
            rule = _RULES[kind]
        rows.append((source, target, _TYPES.get(kind, kind), rule, _policy(contract, target)))
    return rows


def data_dictionary(spark: SparkSession, rows: Sequence[Sequence[str]]) -> DataFrame:
    """Policy table: one row per source field with its target, type, rule and invalid-value policy."""
    columns = ["source_field", "target_field", "spark_type", "cleaning_rule", "invalid_value_policy"]
    return spark.createDataFrame([tuple(row) for row in rows], ", ".join(f"{c} string" for c in columns))
