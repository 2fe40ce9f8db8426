"""Queries on cluster inputs, profiles, sweeps and assignments."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators import clusters, fitting, sampling, shares
from ..operators.ordering import ordered
from ..plans import jobs, schemas as S
from ..sources import files
from .registry import query
from .standins import FACTS_SQL, Tables, key_hash_sql

INPUT_SQL = f"""{FACTS_SQL},
input AS (SELECT crime_id, latitude, longitude, hour, district FROM facts
          WHERE has_valid_coordinates AND hour IS NOT NULL)"""
# Clusters by longitude band stand for fitted ones, so that SQL can follow the tables made from them.
ASSIGNED_SQL = f"""{INPUT_SQL},
assigned AS (SELECT *, (crime_id % 400 // 80)::INTEGER AS cluster FROM input)"""
PROFILE_SQL = f"""{ASSIGNED_SQL},
base AS (
  SELECT cluster, count(*) AS incident_count, avg(latitude) AS centroid_latitude, avg(longitude) AS centroid_longitude,
         avg(hour) AS average_hour, count(DISTINCT district) AS district_count,
         sqrt(var_pop(latitude) + var_pop(longitude)) AS spatial_dispersion FROM assigned GROUP BY cluster),
profile AS (SELECT *, incident_count / greatest(spatial_dispersion, 1e-6) AS activity_concentration_index FROM base)"""
PROFILE_FLOATS = [
    "centroid_latitude",
    "centroid_longitude",
    "average_hour",
    "spatial_dispersion",
    "activity_concentration_index",
]
# One scored fit per (k, seed) made from order prices: enough to check the tables made from a sweep.
SCORES_SQL = """scores AS (
  SELECT 2 + o_custkey % 5 AS k, o_orderkey % 3 AS seed, avg(o_totalprice) / 500000 AS silhouette_score,
         sum(o_totalprice) AS training_cost, min(o_custkey) AS minimum_cluster_size, max(o_custkey) AS maximum_cluster_size,
         avg(o_custkey % 10) / 10 AS average_dominant_district_share FROM orders GROUP BY 1, 2)"""
ROLLUP_SQL = f"""{SCORES_SQL},
rollup AS (
  SELECT k, avg(silhouette_score) AS silhouette_score, coalesce(stddev_samp(silhouette_score), 0) AS silhouette_stddev,
         avg(training_cost) AS training_cost, coalesce(stddev_samp(training_cost), 0) AS training_cost_stddev,
         avg(minimum_cluster_size) AS minimum_cluster_size, avg(maximum_cluster_size) AS maximum_cluster_size,
         avg(average_dominant_district_share) AS average_dominant_district_share FROM scores GROUP BY k)"""
ROLLUP_FLOATS = [
    "silhouette_score",
    "silhouette_stddev",
    "training_cost",
    "training_cost_stddev",
    "minimum_cluster_size",
    "maximum_cluster_size",
    "average_dominant_district_share",
]


def cluster_rows(t: Tables):
    return clusters.cluster_input(
        t.facts(), "has_valid_coordinates", S.CLUSTER_FEATURES, "crime_id", "district"
    )


def assigned(t: Tables):
    band = F.floor(F.col("crime_id") % 400 / 80).cast("int")
    return cluster_rows(t).withColumn("cluster", band)


def score_rows(t: Tables):
    return (
        t.read("orders")
        .groupBy((F.col("o_custkey") % 5 + 2).alias("k"), (F.col("o_orderkey") % 3).alias("seed"))
        .agg(
            (F.avg("o_totalprice") / 500000).alias("silhouette_score"),
            F.sum("o_totalprice").alias("training_cost"),
            F.min("o_custkey").alias("minimum_cluster_size"),
            F.max("o_custkey").alias("maximum_cluster_size"),
            (F.avg(F.col("o_custkey") % 10) / 10).alias("average_dominant_district_share"),
        )
    )


def scaled(t: Tables):
    rows = cluster_rows(t)
    return clusters.scale(rows, rows, S.CLUSTER_FEATURES)


def scaled_points(t: Tables):
    """The distinct points of all rows, with their weights and groups, as the fits read them."""
    rows = cluster_rows(t)
    points = clusters.distinct_points(rows, S.CLUSTER_FEATURES, "district")
    scaled_rows = clusters.scale(rows, fitting.spread(points, S.CLUSTER_FEATURES), S.CLUSTER_FEATURES)
    return scaled_rows.select("features", "weight", "groups")


@query("m1_cluster_input", f"WITH {INPUT_SQL} SELECT * FROM input", floats=["latitude", "longitude"])
def m1_cluster_input(t: Tables):
    return cluster_rows(t)


@query(
    "m2_assemble",
    f"WITH {INPUT_SQL} SELECT crime_id, latitude AS a, longitude AS b, hour::DOUBLE AS c FROM input",
    floats=["a", "b"],
)
def m2_assemble(t: Tables):
    values = vector_to_array("features_raw")
    named = [values[i].alias(name) for i, name in enumerate("abc")]
    return clusters.assemble(cluster_rows(t), S.CLUSTER_FEATURES).select("crime_id", *named)


@query(
    "m3_scale",
    f"""WITH {INPUT_SQL}, train AS (SELECT * FROM input WHERE {key_hash_sql('crime_id')} < {round(0.2 * (1 << 32))}),
        s AS (SELECT avg(latitude) AS ma, stddev_samp(latitude) AS sa, avg(longitude) AS mb,
                     stddev_samp(longitude) AS sb, avg(hour) AS mc, stddev_samp(hour) AS sc FROM train)
        SELECT crime_id, (latitude - ma) / sa AS a, (longitude - mb) / sb AS b, (hour - mc) / sc AS c FROM input, s""",
    floats=["a", "b", "c"],
)
def m3_scale(t: Tables):
    """Fitted on a sample, applied to all rows."""
    rows = cluster_rows(t)
    train = sampling.training_sample(rows, "crime_id", 0.2, S.SMALLEST_SAMPLE, S.SAMPLE_SEED)
    values = vector_to_array("features")
    named = [values[i].alias(name) for i, name in enumerate("abc")]
    return clusters.scale(train, rows, S.CLUSTER_FEATURES).select("crime_id", *named)


@query("m4_assign", f"WITH {INPUT_SQL} SELECT crime_id, true AS nearest FROM input")
def m4_assign(t: Tables):
    """K-Means with K = 3 on all rows: whether no other centre is nearer than the row's own."""
    with fitting.persisted(scaled_points(t)) as train:
        model = clusters.fit_kmeans(train, 3, clusters.SEEDS[0], "weight")
    values = vector_to_array("features")
    distances = [
        sum((values[i] - F.lit(float(x))) ** 2 for i, x in enumerate(centre)) for centre in model.clusterCenters()
    ]
    own = F.array(*distances)[F.col("cluster")]
    assigned_rows = clusters.assign(scaled(t), model, "cluster")
    return assigned_rows.select("crime_id", (own <= F.least(*distances) + 1e-9).alias("nearest"))


@query(
    "m5_silhouette",
    """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
       d AS (SELECT x.vec_id, x.label, y.label AS other, sum(list_distance(x.e, y.e) ** 2) AS total,
                    count(*) AS n FROM v x, v y GROUP BY ALL),
       s AS (SELECT vec_id, max(total / (n - 1)) FILTER (label = other) AS inside,
                    min(total / n) FILTER (label <> other) AS outside FROM d GROUP BY vec_id)
       SELECT avg((outside - inside) / greatest(outside, inside)) AS silhouette FROM s""",
    floats=["silhouette"],
)
def m5_silhouette(t: Tables):
    """Silhouette of the given labels in all dimensions."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    rows = t.read("embeddings").select(vector.alias("features"), F.col("label").alias("cluster"))
    with fitting.persisted(rows) as held:
        score = clusters.silhouette(held)
    return t.spark.createDataFrame([(score,)], "silhouette double")


@query(
    "m6_kmeans_sweep",
    f"""WITH {INPUT_SQL}
        SELECT k::BIGINT AS k, seed::BIGINT AS seed, (SELECT count(*) FROM input) AS records, true AS sound
        FROM (SELECT unnest({list(clusters.CANDIDATES)}) AS k), (SELECT unnest({list(clusters.SEEDS)}) AS seed)""",
)
def m6_kmeans_sweep(t: Tables):
    """Fits on all valid rows, and whether their sizes and scores can be those of K clusters of them."""
    with fitting.persisted(scaled_points(t)) as train:
        records = F.lit(train.agg(F.sum("weight")).first()[0]).cast("long")
        scores = clusters.kmeans_sweep(train, "groups", weight="weight")
    least, most, k = F.col("minimum_cluster_size"), F.col("maximum_cluster_size"), F.col("k")
    sizes = (least >= 1) & (least * k <= records) & (most * k >= records) & (most <= records - (k - 1))
    share = F.col("average_dominant_district_share")
    sound = sizes & F.col("silhouette_score").between(-1, 1) & (F.col("training_cost") > 0) & share.between(0, 1)
    return scores.select("k", "seed", records.alias("records"), sound.alias("sound"))


@query(
    "m7_best_k",
    f"WITH {INPUT_SQL} SELECT count(*) AS records, true AS whole, true AS highest FROM input",
)
def m7_best_k(t: Tables):
    """Rows profiled under the chosen K; whether there are K clusters, and no K scored higher."""
    result = jobs.cluster_facts(t.facts(), files.scratch_dir(t.spark))
    chosen = result.scores.filter(F.col("k") == result.best_k).first()["silhouette_score"]
    higher = result.scores.filter(F.col("silhouette_score") > chosen).count()
    return result.cluster_summary.agg(
        F.sum("incident_count").alias("records"),
        (F.count("*") == result.best_k).alias("whole"),
        F.lit(higher == 0).alias("highest"),
    )


@query("m8_detail_assignment", f"WITH {INPUT_SQL} SELECT crime_id, true AS detailed FROM input")
def m8_detail_assignment(t: Tables):
    """All valid rows, and whether their cluster is that of a K = 6 model fitted apart on the same rows."""
    records = jobs.cluster_facts(t.facts(), files.scratch_dir(t.spark)).detailed_clustered_records
    with fitting.persisted(scaled_points(t)) as train:
        model = clusters.fit_kmeans(train, clusters.DETAIL_K, clusters.SEEDS[0], "weight")
    again = clusters.assign(scaled(t), model, "again").select("crime_id", "again")
    return records.join(again, "crime_id", "left").select("crime_id", F.col("cluster").eqNullSafe(F.col("again")).alias("detailed"))


@query("a17_cluster_profile", f"WITH {PROFILE_SQL} SELECT * FROM profile", floats=PROFILE_FLOATS)
def a17_cluster_profile(t: Tables):
    return clusters.cluster_profile(assigned(t), "cluster", "district")


@query(
    "a18_flag_hotspots",
    f"""WITH {PROFILE_SQL} SELECT *,
        activity_concentration_index >= (SELECT avg(activity_concentration_index) FROM profile) AS is_high_activity_zone,
        district_count > 1 AS crosses_district_boundaries FROM profile""",
    floats=PROFILE_FLOATS,
)
def a18_flag_hotspots(t: Tables):
    return clusters.flag_hotspots(clusters.cluster_profile(assigned(t), "cluster", "district"), "district")


ALIGNMENT_SQL = """SELECT cluster, district, count(*) AS incident_count,
    round(count(*) / sum(count(*)) OVER (PARTITION BY cluster), 4) AS cluster_share FROM assigned {}
    GROUP BY cluster, district"""


@query("a19_alignment", f"WITH {ASSIGNED_SQL} {ALIGNMENT_SQL.format('')}")
def a19_alignment(t: Tables):
    return shares.alignment(assigned(t), "cluster", "district", "incident_count", True)


@query("a19_alignment_known", f"WITH {ASSIGNED_SQL} {ALIGNMENT_SQL.format('WHERE district IS NOT NULL')}")
def a19_alignment_known(t: Tables):
    return shares.alignment(assigned(t), "cluster", "district", "incident_count", False)


@query(
    "a20_dominant_share",
    f"""WITH {ASSIGNED_SQL}, c AS (SELECT cluster, district, count(*) AS n FROM assigned
                                 WHERE district IS NOT NULL GROUP BY ALL)
        SELECT avg(share) AS average_dominant_district_share
        FROM (SELECT max(n) / sum(n) AS share FROM c GROUP BY cluster)""",
    floats=["average_dominant_district_share"],
)
def a20_dominant_share(t: Tables):
    return shares.dominant_share(assigned(t), "cluster", "district", "average_dominant_district_share")


@query(
    "a25_size_range",
    """SELECT min(n) AS minimum_cluster_size, max(n) AS maximum_cluster_size
       FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)""",
)
def a25_size_range(t: Tables):
    return clusters.size_range(t.read("embeddings"), "label")


@query("a24_stability_rollup", f"WITH {ROLLUP_SQL} SELECT * FROM rollup", floats=ROLLUP_FLOATS)
def a24_stability_rollup(t: Tables):
    return clusters.stability_rollup(score_rows(t))


@query(
    "r2_silhouette_by_k",
    f"WITH {ROLLUP_SQL} SELECT k, silhouette_score, silhouette_stddev FROM rollup",
    floats=["silhouette_score", "silhouette_stddev"],
    order="k",
)
def r2_silhouette_by_k(t: Tables):
    rollup = clusters.stability_rollup(score_rows(t))
    return ordered(rollup.select("k", "silhouette_score", "silhouette_stddev"), "k")


@query("r3_cost_by_k", f"WITH {ROLLUP_SQL} SELECT k, training_cost FROM rollup", floats=["training_cost"], order="k")
def r3_cost_by_k(t: Tables):
    return ordered(clusters.stability_rollup(score_rows(t)).select("k", "training_cost"), "k")


@query(
    "o4_best_by",
    f"""WITH {ROLLUP_SQL} SELECT k, silhouette_score FROM rollup ORDER BY silhouette_score DESC, k LIMIT 1""",
    floats=["silhouette_score"],
)
def o4_best_by(t: Tables):
    rollup = clusters.stability_rollup(score_rows(t)).select("k", "silhouette_score")
    return clusters.best_by(rollup, "silhouette_score", "k")


@query(
    "a28_require_varying",
    f"WITH {INPUT_SQL} SELECT hour, count(*) AS records FROM input GROUP BY hour",
)
def a28_require_varying(t: Tables):
    """Rows per hour, once it is sure that the hour varies."""
    rows = cluster_rows(t)
    clusters.require_varying(rows, "hour")
    return rows.groupBy("hour").agg(F.count("*").alias("records"))


@query(
    "r10_map_points",
    f"""WITH {ASSIGNED_SQL} SELECT crime_id, latitude, longitude, cluster FROM assigned
        WHERE {key_hash_sql('crime_id')} < {round(S.MAP_FRACTION * (1 << 32))}
        ORDER BY {key_hash_sql('crime_id')}, crime_id LIMIT {S.MAP_CAP}""",
    floats=["latitude", "longitude"],
)
def r10_map_points(t: Tables):
    points = assigned(t).select("crime_id", "latitude", "longitude", "cluster")
    return sampling.bounded_sample(points, "crime_id", S.MAP_FRACTION, S.MAP_CAP, S.SAMPLE_SEED)
