"""Queries that write a table and read it back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators import explore, models
from ..operators.ordering import ordered
from ..plans import schemas as S
from ..sources import files, payload
from .registry import query
from .standins import FACTS_SQL, Tables, key_hash_sql

EVENT_TEXT = [
    "string(event_id) AS event_id",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS ts",
    "event_type",
    "string(cast(value as decimal(18, 2))) AS value",
    "props",
]
EVENT_TEXT_SQL = """SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type,
    value::DECIMAL(18, 2)::VARCHAR AS value, props FROM events"""
TYPE_COUNTS_SQL = "SELECT event_type, count(*)::VARCHAR AS records FROM events GROUP BY event_type"


def type_counts(t: Tables):
    return t.read("events").groupBy("event_type").agg(F.count("*").alias("records"))


@query("s1_raw_csv", EVENT_TEXT_SQL)
def s1_raw_csv(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/events"
    t.read("events").selectExpr(*EVENT_TEXT).write.option("header", True).csv(path)
    return files.read_raw_csv(t.spark, path)


@query("s2_read_table", "SELECT o_orderkey, o_totalprice FROM orders", floats=["o_totalprice"])
def s2_read_table(t: Tables):
    return files.read_table(t.spark, f"{t.sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")


@query("s3_write_partitioned", f"WITH {FACTS_SQL} SELECT crime_id, primary_type, year, district FROM facts")
def s3_write_partitioned(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/facts"
    columns = ["crime_id", "primary_type", "year", "district"]
    files.write_partitioned(t.facts().select(*columns), path, ["year", "district"])
    return files.read_table(t.spark, path).select(*columns)


@query("s4_write_table", "SELECT event_type, count(*) AS records FROM events GROUP BY event_type")
def s4_write_table(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/counts"
    files.write_table(type_counts(t), path)
    return files.read_table(t.spark, path)


@query("s5_write_mode", "SELECT o_orderkey, o_orderstatus, true AS refused FROM orders")
def s5_write_mode(t: Tables):
    """Overwriting replaces the table; ``errorifexists`` refuses."""
    path = f"{files.scratch_dir(t.spark)}/orders"
    orders = t.read("orders").select("o_orderkey", "o_orderstatus")
    files.write_table(orders.withColumn("o_orderstatus", F.lit("old")), path)
    files.write_table(orders, path)
    refused = False
    try:
        files.write_table(orders, path, "errorifexists")
    except AnalysisException:
        refused = True
    return files.read_table(t.spark, path).withColumn("refused", F.lit(refused))


@query(
    "s6_write_quarantine",
    f"""WITH {FACTS_SQL} SELECT crime_id, community_area, concat_ws(',',
          CASE WHEN NOT has_valid_crime_id THEN 'invalid_crime_id' END,
          CASE WHEN NOT has_valid_timestamp THEN 'invalid_timestamp' END) AS rejection_reason
        FROM facts WHERE NOT (has_valid_crime_id AND has_valid_timestamp)""",
)
def s6_write_quarantine(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/quarantine"
    files.write_quarantine(t.facts(), S.INCIDENT_REASONS, path)
    return files.read_table(t.spark, path).select("crime_id", "community_area", "rejection_reason")


@query("s7_export_csv", TYPE_COUNTS_SQL)
def s7_export_csv(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/counts"
    files.export_csv(type_counts(t), path, ["event_type"])
    return files.read_raw_csv(t.spark, path)


@query(
    "s8_export_stage",
    f"""SELECT 'events' AS source, event_type AS name, records FROM ({TYPE_COUNTS_SQL}) UNION ALL
        SELECT 'orders', o_orderpriority, count(*)::VARCHAR FROM orders GROUP BY o_orderpriority""",
)
def s8_export_stage(t: Tables):
    folder = files.scratch_dir(t.spark)
    priorities = t.read("orders").groupBy("o_orderpriority").agg(F.count("*").alias("records"))
    files.write_table(type_counts(t), f"{folder}/events")
    files.write_table(priorities, f"{folder}/orders")
    tables = {
        "first": {"events": (f"{folder}/events", ["event_type"])},
        "second": {"orders": (f"{folder}/orders", ["o_orderpriority"])},
    }
    paths = files.export_stage(t.spark, tables, ["first", "second"], f"{folder}/evidence")
    frames = [files.read_raw_csv(t.spark, path) for path in paths]
    named = [df.toDF("name", "records").select(F.lit(source).alias("source"), "name", "records")
             for df, source in zip(frames, ("events", "orders"))]
    return named[0].unionByName(named[1])


@query(
    "s9_write_sample",
    f"""SELECT event_id, value FROM events WHERE {key_hash_sql('event_id')} < {round(S.OUTPUT_FRACTION * (1 << 32))}
        ORDER BY {key_hash_sql('event_id')}, event_id LIMIT {S.OUTPUT_CAP}""",
    floats=["value"],
)
def s9_write_sample(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/sample"
    rows = t.read("events").select("event_id", "value")
    files.write_sample(rows, path, S.OUTPUT_FRACTION, S.OUTPUT_CAP, "event_id", S.SAMPLE_SEED)
    return files.read_table(t.spark, path)


@query(
    "s10_save_model",
    """WITH ranked AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i
                       FROM orders GROUP BY o_orderpriority)
       SELECT o_orderkey, i::DOUBLE AS primary_type_index FROM orders JOIN ranked USING (o_orderpriority)""",
)
def s10_save_model(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/model"
    rows = t.read("orders").selectExpr("o_orderkey", "o_orderpriority AS primary_type")
    model = Pipeline(stages=[models.category_index(S.MODEL)]).fit(rows)
    files.save_model(model, path)
    files.save_model(model, path)
    return PipelineModel.load(path).transform(rows).select("o_orderkey", "primary_type_index")


@query(
    "s11_explode_aligned",
    """SELECT 'grid cell' AS weather_location, vec_id::VARCHAR || ':' || (pos - 1)::VARCHAR AS time,
              (embedding[pos]::DOUBLE)::DECIMAL(18, 6)::DOUBLE AS temperature_2m, (pos * 2)::DOUBLE AS weather_code
       FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings)""",
    floats=["temperature_2m", "weather_code"],
)
def s11_explode_aligned(t: Tables):
    """One JSON document per vector, with its position, its values and a made code as aligned arrays."""
    path = f"{files.scratch_dir(t.spark)}/payload"
    documents = t.read("embeddings").selectExpr(
        """struct(transform(embedding, (x, i) -> concat(vec_id, ':', i)) AS time,
                  transform(embedding, x -> double(cast(double(x) as decimal(18, 6)))) AS temperature_2m,
                  transform(embedding, (x, i) -> double(2 * (i + 1))) AS weather_code) AS hourly"""
    )
    documents.write.json(path)
    series = {"temperature_2m": DoubleType(), "weather_code": DoubleType()}
    read = payload.read_payloads(t.spark, path, S.PAYLOAD_ROOT, S.PAYLOAD_TIME, series)
    return payload.explode_aligned(
        read, S.PAYLOAD_ROOT, S.PAYLOAD_TIME, list(series), {"weather_location": "grid cell"}
    )


@query(
    "f8_pruned_lookup",
    f"""WITH {FACTS_SQL} SELECT crime_id, year, district FROM facts WHERE year = 1998 AND district = 11""",
)
def f8_pruned_lookup(t: Tables):
    path = f"{files.scratch_dir(t.spark)}/facts"
    files.write_partitioned(t.facts().select("crime_id", "year", "district"), path, ["year", "district"])
    chosen = (F.col("year") == 1998) & (F.col("district") == 11)
    return files.read_table(t.spark, path).filter(chosen).select("crime_id", "year", "district")


@query(
    "o1_ordered_table",
    f"""WITH {FACTS_SQL} SELECT year, month, day_of_week, hour, count(*) AS crime_count FROM facts
        WHERE incident_timestamp IS NOT NULL GROUP BY ALL""",
    order="year, month, day_of_week, hour",
)
def o1_ordered_table(t: Tables):
    """The temporal table as the exploration job orders it."""
    patterns = explore.temporal_patterns(t.facts(), "incident_timestamp", "crime_count")
    return ordered(patterns, "year", "month", "day_of_week", "hour")
