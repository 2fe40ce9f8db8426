"""Contracts, flags, rejection, dedup, quality."""

import pytest
from pyspark.sql import functions as F

from tallyfield.operators import contracts, quality
from tallyfield.plans import schemas as S
from tallyfield.sources import files

COLUMNS = ["ID", "Date", "District", "Community Area", "Latitude", "Longitude", "Arrest", "Domestic", "Primary Type"]


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{c}` string" for c in COLUMNS))


def incident(id_="1", date="01/02/2012 01:30:00 PM", district="12", area="7", lat="41.88", lon="-87.63",
             arrest="true", domestic="false", kind="THEFT"):
    return (id_, date, district, area, lat, lon, arrest, domestic, kind)


def clean(df):
    return contracts.clean(contracts.prepare(df, S.INCIDENTS), S.INCIDENTS)


def test_bad_time_and_duplicate_id(spark):
    rows = clean(raw(spark, incident(), incident(), incident("2", "not-a-date"))).collect()
    assert len(rows) == 1 and rows[0].year == 2012 and rows[0].hour == 13 and rows[0].arrest is True


def test_missing_geography_is_kept_and_flagged(spark):
    row = clean(raw(spark, incident(district=None, area=None, lat=None, lon=None))).first()
    assert (row.has_valid_coordinates, row.has_valid_district, row.has_valid_community_area) == (False,) * 3


def test_null_ids_are_rejected(spark):
    assert clean(raw(spark, incident(None), incident(None), incident("-5"))).count() == 0


def test_clean_contract(spark):
    assert clean(raw(spark, incident())).columns == list(S.INCIDENTS.columns)


def test_missing_columns_fail_early(spark):
    only_id = spark.createDataFrame([("1",)], "ID string")
    with pytest.raises(ValueError, match="missing required columns: Arrest, Community Area"):
        contracts.prepare(only_id, S.INCIDENTS)


def test_two_headers_for_one_column_fail(spark):
    both = spark.createDataFrame([("a", "b")], "DATE string, Date string")
    with pytest.raises(ValueError, match="Date"):
        contracts.normalize_columns(both, S.INCIDENTS.aliases)


def test_prepared_keeps_raw_text(spark):
    prepared = contracts.prepare(raw(spark, incident(lat="abc")), S.INCIDENTS)
    row = prepared.first()
    assert row.raw_latitude == "abc" and row.latitude is None and row["Date"] == "01/02/2012 01:30:00 PM"


def test_quarantine_has_reasons_and_no_duplicates_of_clean_rows(spark):
    prepared = contracts.prepare(
        raw(spark, incident(), incident(), incident("0"), incident("x", "y")), S.INCIDENTS
    )
    got = [r.rejection_reason for r in contracts.quarantine(prepared, S.INCIDENT_REASONS).collect()]
    assert sorted(got) == ["invalid_crime_id", "invalid_crime_id,invalid_timestamp"]


@pytest.mark.parametrize("lat, lon, valid", [
    ("41.0", "-88.5", True), ("43.0", "-87.0", True), ("40.999", "-87.5", False), ("0", "0", False), ("NaN", "-87.5", False),
])
def test_bounds_are_inclusive(spark, lat, lon, valid):
    assert clean(raw(spark, incident(lat=lat, lon=lon))).first().has_valid_coordinates is valid


def test_quality_of_empty_input_is_zero(spark):
    prepared = contracts.prepare(raw(spark, incident()).limit(0), S.INCIDENTS)
    cleaned = contracts.clean(prepared, S.INCIDENTS)
    row = quality.quality_row(prepared, cleaned, S.SOURCE_DEFECTS, S.CLEAN_DEFECTS, "crime_id").first()
    assert len(row) == 12 and set(row) == {0}


def test_lookup_drops_total_row_and_copies(spark, tables):
    lookup = contracts.prepare_lookup(tables.raw_lookup(), S.AREAS)
    assert lookup.columns == S.AREAS.columns
    keys = [row.community_area for row in lookup.collect()]
    assert len(keys) == len(set(keys)) and min(keys) >= 1


def test_dedup_prefers_the_stated_order(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (1, None, "c"), (2, 1, "d")], "k int, o int, v string")
    got = contracts.dedup(rows, ["k"], ["o"], F.col("o").isNotNull()).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 3, "b"), (2, 1, "d")]


def test_dedup_on_all_columns_is_distinct(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.k for r in contracts.dedup(rows, ["k"]).collect()) == [1, 2]


@pytest.fixture
def keeper(spark, tmp_path):
    return lambda df: files.stage(df, str(tmp_path), "repeats")


@pytest.mark.parametrize("limit", [None, 0, 10_000])
def test_dedup_by_any_join_equals_the_minimum(spark, tables, monkeypatch, keeper, limit):
    monkeypatch.setattr(contracts, "MAX_BROADCAST_ROWS", limit)
    rows = tables.prepared().select("crime_id", "incident_timestamp", "district", "block", "latitude")
    rows = rows.unionByName(rows.filter("crime_id % 5 = 0"))
    keys, order = ["crime_id"], ["incident_timestamp"]
    plain = contracts._smallest(rows, keys, order, rows.columns)
    got = contracts.dedup(rows, keys, order, keep=None if limit is None else keeper)
    assert got.columns == plain.columns and got.count() == plain.count()
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0


@pytest.mark.parametrize("kind", ["long", "string", "double", "array<int>"])
def test_dedup_orders_null_first_and_keeps_null_keys(spark, kind):
    made = {"long": [3, None, 1], "string": ["c", None, "a"], "double": [float("nan"), None, -0.5], "array<int>": [[3], None, [1]]}[kind]
    rows = [(k, o, v) for k in (None, 1, 2) for o in made for v in ("x", "y") if not (k == 2 and o is None)]
    df = spark.createDataFrame([*rows, *rows, (9, None, "z")], f"k int, o {kind}, v string")
    got = {r.k: (r.o, r.v) for r in contracts.dedup(df, ["k"], ["o"]).collect()}
    assert got == {None: (None, "x"), 1: (None, "x"), 2: (made[2], "x"), 9: (None, "z")}


def test_rows_with_a_key_of_their_own_are_never_sorted(spark, keeper):
    rows = spark.range(300).selectExpr("id AS k", "timestamp_seconds(id % 7) AS t", "string(id) AS wide")
    for keep in (None, keeper):
        text = contracts.dedup(rows, ["k"], ["t"], keep=keep)._jdf.queryExecution().executedPlan().toString()
        single = text[: text.index("LeftSemi")]
        assert "LeftAnti" in single and "HashJoin" in single
        below = single[single.index("LeftAnti") :]
        assert "Sort" not in below.split("SortAggregate")[0] and "SortMergeJoin" not in text


def test_many_repeats_and_a_hot_key(spark, keeper):
    rows = spark.range(450_000).selectExpr(
        "CASE WHEN id < 150000 THEN -1 ELSE id % 200000 END AS k", "timestamp_seconds(id % 1000) AS t", "id AS v"
    )
    got = contracts.dedup(rows, ["k"], ["t"], keep=keeper)
    want = contracts._smallest(rows, ["k"], ["t"], rows.columns)
    assert got.count() == 200_001 and got.exceptAll(want).count() == 0


def test_hourly_rollup_sorts_no_observation(tables):
    text = tables.hourly_weather()._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and text.count("HashAggregate") == 4


def test_dictionary_follows_the_contract():
    rows = {r[0]: r[1:] for r in contracts.dictionary_rows(S.INCIDENTS)}
    assert list(rows) == list(S.INCIDENTS.required)
    assert rows["ID"] == ("crime_id", "long", "whole part of a trimmed number", "row rejected if missing or below 1")
    assert rows["Date"][1] == "timestamp" and rows["Date"][3] == "row rejected if missing"
    assert rows["District"][3] == "row kept, has_valid_district false if missing or below 1 or above 31"
    assert rows["Arrest"][1:] == ("boolean", "trimmed word, upper or lower case", "row kept")


def test_only_rejected_rows_keep_their_raw_text(tables):
    """The staged rows of accepted incidents hold no raw text that no output shows; outputs are the same."""
    prepared = contracts.prepare(tables.raw_incidents(), S.INCIDENTS)
    staged = contracts.blank_accepted_text(prepared, S.INCIDENTS)
    assert staged.columns == prepared.columns
    accepted = staged.filter("has_valid_crime_id AND has_valid_timestamp")
    assert accepted.filter("ID IS NOT NULL OR Date IS NOT NULL OR raw_district IS NOT NULL").isEmpty()
    for build in (lambda df: contracts.quarantine(df, S.INCIDENT_REASONS), lambda df: contracts.clean(df, S.INCIDENTS)):
        before, after = build(prepared), build(staged)
        assert before.count() == after.count() > 0
        assert before.exceptAll(after).isEmpty()
