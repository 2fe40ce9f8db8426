"""Hard negatives by inner product: lists of candidates that clusters of anchors share, walked to a certified end.

Anchors are clustered by direction. For a cluster with centre c and widest angle r, no anchor a of it has a larger inner
product with a candidate x than |a| |x| cos(max(0, angle(x, c) - r)). So each cluster has one list of candidates, in
falling order of |x| cos(max(0, angle(x, c) - r)); every member walks that list, and may stop as soon as the bound of
what is left lies below what it still looks for.

The list is cut into rungs, the highest first, and each rung by a hash into slices. A rung is sorted and written when a
cluster first needs it, and both walks read it: the one for positives, then the one for negatives below them. Anchors
that are done take no part in the next rung. Candidates with one label and vector are one entry of the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from .common import map_rows, stage

#: Anchors that the clusters are learned from at most, chosen by a hash of the key.
SAMPLE = 2048
#: Bins of the bound that rungs are cut at, and the shares of a list that end the rungs.
BINS, RUNGS = 256, (1 / 32, 1 / 4, 1.0)
#: Entries in a slice on average, anchors that walk side by side, entries of a first step of theirs.
SLICE, SIDE_BY_SIDE, STEP = 8192, 256, 512
#: What rounding can add to an angle, and to a bound as a share.
ANGLE_SLACK, SHARE_SLACK = 1e-6, 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Equally long lists of numbers as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _map_arrow(df: DataFrame, schema: str, fn) -> DataFrame:
    """``fn`` of each Arrow batch gives the columns of a batch."""
    fields = StructType.fromDDL(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(fields)
        for batch in source:
            if len(batch):
                columns = fn(batch)
                arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, target)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(batches, fields)


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths of rows; a row of zeros has no direction."""
    lengths = np.sqrt((vectors * vectors).sum(1))
    return vectors / np.where(lengths > 0, lengths, 1)[:, None], lengths


def cluster_centres(vectors: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Directions of at most so many clusters: the farthest rows first, then means."""
    directions = unit(vectors)[0]
    directions = directions[(directions != 0).any(1)]
    if not len(directions):
        return np.zeros((1, vectors.shape[1]))
    chosen = [directions[0]]
    nearest = directions @ chosen[0]
    while len(chosen) < clusters and nearest.min() < 1 - 1e-9:
        chosen.append(directions[int(nearest.argmin())])
        nearest = np.maximum(nearest, directions @ chosen[-1])
    centres = np.array(chosen)
    for _ in range(rounds):
        own = (directions @ centres.T).argmax(1)
        sums = np.array([directions[own == i].sum(0) if (own == i).any() else c for i, c in enumerate(centres)])
        centres = np.where((sums != 0).any(1)[:, None], unit(sums)[0], centres)
    return centres


def angles(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angle of each row to each centre, and the rows' lengths."""
    directions, lengths = unit(vectors)
    return np.arccos(np.clip(directions @ centres.T, -1, 1)), lengths


def list_bounds(vectors: np.ndarray, centres: np.ndarray, widest: np.ndarray) -> np.ndarray:
    """For each row and cluster, the largest inner product with a member of length 1."""
    to_centre, lengths = angles(vectors, centres)
    return lengths[:, None] * np.cos(np.maximum(0, to_centre - widest - ANGLE_SLACK))


def _products(entries: np.ndarray, anchors: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products as integers; ``top`` bounds what any of them can be."""
    if top < 1 << 53:
        return np.rint(entries.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return (entries.astype(object) @ anchors.astype(object).T).astype(np.int64)


def _first(scores: np.ndarray, keys: list[list[int]], at: np.ndarray, own: int, most: int, held: list[tuple[int, int]]):
    """The first ``most`` of what is held as (-score, key) and the rows of some entries, without the anchor's own."""
    if len(at) > most:
        at = at[scores[at] >= np.partition(scores[at], -most - 1)[-most - 1]]  # an entry may be the anchor's row alone
    found = [(-int(scores[i]), key) for i in at.tolist() for key in keys[i] if key != own]
    return sorted({*held, *found})[:most]


class Walker:
    """One slice of a list: entries in falling order of their bounds."""

    def __init__(self, bounds: np.ndarray, labels: np.ndarray, vectors: np.ndarray, keys: list[list[int]], top: float):
        order = np.argsort(-bounds, kind="stable")
        self.bounds, self.labels, self.vectors = bounds[order], labels[order], vectors[order]
        self.keys, self.top = [keys[i] for i in order.tolist()], top

    def walk(self, anchors: np.ndarray, seekers: list) -> None:
        """Let anchors walk side by side; each seeker says when it is done and takes what it meets."""
        going = np.arange(len(seekers))
        lengths = np.sqrt((anchors.astype(np.float64) ** 2).sum(1))
        at, step = 0, STEP
        while at < len(self.bounds):
            left = self.bounds[at]
            best = left * lengths * (1 + np.sign(left) * SHARE_SLACK) + 1e-6
            going = np.array([i for i in going.tolist() if not seekers[i].done(best[i])], np.int64)
            if not len(going):
                return
            scores = _products(self.vectors[at : at + step], anchors[going], self.top)
            for column, i in enumerate(going.tolist()):
                seekers[i].meet(scores[:, column], self.labels[at : at + step], self.keys[at : at + step])
            at, step = at + step, min(2 * step, 8 * STEP)


class PositiveSeeker:
    """Looks for the first rows with the anchor's label."""

    def __init__(self, key: int, label: int, most: int, floor: int | None):
        self.key, self.label, self.most, self.floor = key, label, most, floor
        self.held: list[tuple[int, int]] = []

    def _floor(self) -> int | None:
        """A score that the last place already has."""
        own = -self.held[-1][0] if len(self.held) == self.most else None
        return max((x for x in (own, self.floor) if x is not None), default=None)

    def done(self, best: float) -> bool:
        floor = self._floor()
        return floor is not None and floor > best

    def meet(self, scores: np.ndarray, labels: np.ndarray, keys: list[list[int]]) -> None:
        floor, mine = self._floor(), labels == self.label
        at = np.flatnonzero(mine if floor is None else mine & (scores >= floor))
        if len(at):
            self.held = _first(scores, keys, at, self.key, self.most, self.held)

    def found(self) -> Iterator[tuple[int | None, int, int]]:
        for score, key in self.held:
            yield None, -score, key


class NegativeSeeker:
    """Looks for the first rows with another label in the band below each positive score."""

    def __init__(self, key: int, label: int, most: int, caps: list[int], floors: list[int | None], band: tuple[int, int]):
        self.label = label
        self.seekers = [
            (cap, -(-band[0] * cap // band[1]), PositiveSeeker(key, label, most, floor)) for cap, floor in zip(caps, floors)
        ]

    def done(self, best: float) -> bool:
        return all(least > best or s.done(best) for _, least, s in self.seekers)

    def meet(self, scores: np.ndarray, labels: np.ndarray, keys: list[list[int]]) -> None:
        other = np.flatnonzero(labels != self.label)
        other = other[scores[other] <= max((cap for cap, _, _ in self.seekers), default=0)]
        for cap, least, s in self.seekers:
            floor, own = s._floor(), scores[other]
            fits = (least <= own) & (own <= cap)
            at = other[fits if floor is None else fits & (own >= floor)]
            if len(at):
                s.held = _first(scores, keys, at, s.key, s.most, s.held)

    def found(self) -> Iterator[tuple[int, int, int]]:
        for cap, _, s in self.seekers:
            for _, score, key in s.found():
                yield cap, score, key


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    folder: str,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 5,
    band: tuple[int, int] = (80, 100),
    clusters: int = 8,
) -> DataFrame:
    """For each anchor and positive, the hardest negatives that are not harder than the positive by far.

    ``vector`` holds whole numbers. A row's score is its inner product with the anchor; higher scores come first, ties
    by smaller key. An anchor's positives are its first other rows of the same label; its negatives for a positive are
    the first rows of other labels whose score s has ``band[0] * positive <= band[1] * s <= band[1] * positive``. Returns
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Rows with a null key, label, vector or component take no part, and no row with the anchor's own key is its positive
    or negative. Shorter vectors are filled up with zeros. A row that is repeated as it is counts once. No anchor, no
    positive or an empty table give no row. Other columns are not read; ``folder`` takes the staged tables. Scores
    beyond 64 bits end the job.
    """
    spark, most = rows.sparkSession, max(positives, negatives) + 1
    given = rows.select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"),
        F.transform(vector, lambda x: x.cast("long")).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).where("key is not null and label is not null and vector is not null and not exists(vector, x -> x is null)")
    reach = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("decimal(20,0)")))).cast("double")
    first = given.agg(F.max(F.size("vector")), F.max(reach)).first()
    width, tallest = max(1, first[0] or 0), first[1] or 0.0
    top = width * tallest * tallest
    packing = np.dtype("<i2" if tallest < 1 << 15 else "<i8")
    given = given.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))))

    # Of rows with one label and vector only the first keys can be returned.
    nth = F.dense_rank().over(Window.partitionBy("label", "vector").orderBy("key"))
    entries = given.select("key", "label", "vector", nth.alias("nth")).where(F.col("nth") <= most)
    entries = entries.groupBy("label", "vector").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    entries = stage(entries, folder, "entries")
    anchors = given.where("anchor").select("key", "label", "vector").distinct()
    anchors = stage(anchors.withColumn("aid", F.monotonically_increasing_id()), folder, "anchors-given")

    sample = anchors.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("vector").collect()
    sample = np.array([r[0] for r in sample], np.float64).reshape(-1, width)
    centres = cluster_centres(sample, clusters)

    def assign(batch: pa.RecordBatch):
        vectors = _matrix(batch.column("vector"), width)
        to_centre, lengths = angles(vectors.astype(np.float64), centres)
        own = to_centre.argmin(1)
        angle = np.where(lengths > 0, to_centre[np.arange(len(own)), own], 0)
        packed = [v.tobytes() for v in vectors.astype(packing)]
        return batch.column("aid"), batch.column("key"), batch.column("label"), packed, own, angle, lengths

    schema = "aid long, key long, label long, vector binary, cluster int, angle double, length double"
    anchors = stage(_map_arrow(anchors.select("aid", "key", "label", "vector"), schema, assign), folder, "anchors")
    widest = np.zeros(len(centres))
    for row in anchors.groupBy("cluster").agg(F.max("angle")).collect():
        widest[row[0]] = row[1]
    ceiling = max(np.sqrt(width) * tallest, 1e-9)

    def bins_of(bounds: np.ndarray) -> np.ndarray:
        """Bins of bounds, 0 the highest."""
        return np.clip(((ceiling - bounds) / (2 * ceiling) * BINS).astype(np.int64), 0, BINS - 1)

    def histogram(batch: pa.RecordBatch):
        bins = bins_of(list_bounds(_matrix(batch.column("vector"), width).astype(np.float64), centres, widest))
        codes, n = np.unique(bins + BINS * np.arange(len(centres)), return_counts=True)
        return codes // BINS, codes % BINS, n

    counted = _map_arrow(entries.select("vector"), "cluster int, bin int, n long", histogram)
    counts = np.zeros((len(centres), BINS), np.int64)
    for row in counted.groupBy("cluster", "bin").agg(F.sum("n")).collect():
        counts[row[0], row[1]] = row[2]
    share = np.cumsum(counts, 1) / max(1, counts[0].sum())
    rung_of = np.minimum((share[:, :, None] > np.array(RUNGS) + 1e-12).sum(2), len(RUNGS) - 1)
    sizes = np.array([[counts[c][rung_of[c] == r].sum() for r in range(len(RUNGS))] for c in range(len(centres))])
    slices = np.maximum(1, -(-sizes // SLICE))
    #: The highest bound that a rung can hold.
    tops = [[ceiling * (1 - 2 * int((rung_of[c] < r).sum()) / BINS) for r in range(len(RUNGS))] for c in range(len(centres))]
    lists: dict[int, DataFrame] = {}

    def list_of(rung: int) -> DataFrame:
        """The entries of every cluster's list on one rung."""
        if rung not in lists:

            def on_rung(batch: pa.RecordBatch):
                vectors = _matrix(batch.column("vector"), width)
                bounds = list_bounds(vectors.astype(np.float64), centres, widest)
                at, cluster = np.nonzero(rung_of[np.arange(len(centres)), bins_of(bounds)] == rung)
                packed = [v.tobytes() for v in vectors.astype(packing)]
                part = batch.column("hash").to_numpy()[at] % slices[cluster, rung]
                taken = pa.array(at)
                return (
                    cluster, part, bounds[at, cluster], batch.column("label").take(taken), [packed[i] for i in at.tolist()],
                    batch.column("keys").take(taken),
                )

            hashed = entries.select("label", "vector", "keys", F.shiftrightunsigned(F.xxhash64("vector"), 1).alias("hash"))
            schema = "cluster int, slice long, bound double, label long, vector binary, keys array<long>"
            entries_on = _map_arrow(hashed, schema, on_rung).repartition(int(slices[:, rung].sum()), "cluster", "slice")
            lists[rung] = stage(entries_on.sortWithinPartitions("cluster", "slice", F.desc("bound")), folder, f"rung-{rung}")
        return lists[rung]

    def walk(active: DataFrame, rung: int, seeker) -> DataFrame:
        """``aid``, ``cap``, ``score``, ``key`` of what active anchors find on a rung."""
        parts = F.array(*[F.lit(int(n)) for n in slices[:, rung]])
        meeting = active.select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), F.get(parts, F.col("cluster")).cast("long") - 1)).alias("slice")
        )
        wanted = active.select("cluster").distinct()  # at most a row for each cluster
        both = meeting.unionByName(list_of(rung).join(F.broadcast(wanted), "cluster"), allowMissingColumns=True)
        both = both.repartition(int(slices[:, rung].sum()), "cluster", "slice")
        both = both.sortWithinPartitions("cluster", "slice", F.col("bound").desc_nulls_last())
        names = ["cluster", "slice", "bound", "label", "vector", "keys", "aid", "key", "caps", "floors"]

        def meet(given: Iterator[tuple]) -> Iterator[tuple]:
            now, list_, walker, waiting = None, [], None, []

            def go():
                vectors = np.frombuffer(b"".join(w[4] for w in waiting), packing).reshape(len(waiting), width)
                seekers = [seeker(key, label, caps, floors) for _, _, _, label, _, _, _, key, caps, floors in waiting]
                walker.walk(vectors, seekers)
                for w, s in zip(waiting, seekers):
                    for cap, score, key in s.found():
                        yield w[6], cap, score, key
                waiting.clear()

            for row in given:
                if row[:2] != now:
                    if waiting:
                        yield from go()
                    now, list_, walker = row[:2], [], None
                if row[2] is not None:
                    list_.append(row)
                    continue
                if walker is None:
                    vectors = np.frombuffer(b"".join(x[4] for x in list_), packing).reshape(len(list_), width)
                    bounds, labels = np.array([x[2] for x in list_], np.float64), np.array([x[3] for x in list_], np.int64)
                    walker, list_ = Walker(bounds, labels, vectors, [x[5] for x in list_], top), []
                waiting.append(row)
                if len(waiting) >= SIDE_BY_SIDE:
                    yield from go()
            if waiting:
                yield from go()

        return map_rows(both.select(*names), "aid long, cap long, score long, key long", meet)

    def merged(found: DataFrame, n: int) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy("aid", "cap").orderBy(F.desc("score"), "key"))
        return found.distinct().withColumn("nth", nth).where(F.col("nth") <= n)

    def rungs(name: str, start: DataFrame, floors_of, n: int, seeker, still) -> DataFrame:
        """Walk from rung to rung with the anchors that are not done."""
        found, active = None, start
        for rung in range(len(RUNGS)):
            new = walk(active, rung, seeker)
            new = new if found is None else new.unionByName(found.drop("nth"))
            found = stage(merged(new, n), folder, f"{name}-{rung}")
            if rung + 1 < len(RUNGS):
                tops_next = F.array(*[F.lit(float(t[rung + 1])) for t in tops])
                best = F.get(tops_next, F.col("cluster")) * F.col("length")
                best = best * (1 + F.signum(best) * SHARE_SLACK) + 1e-6
                active = stage(floors_of(start, found).where(still(best)), folder, f"{name}-active-{rung}")
                if active.isEmpty():
                    break
        return found

    columns = ["aid", "key", "label", "vector", "cluster", "length"]

    def positive_floors(start: DataFrame, found: DataFrame) -> DataFrame:
        last = found.where(F.col("nth") == positives).select("aid", F.array("score").alias("floors"))
        return start.drop("floors").join(last, "aid", "left")

    none = F.lit(None).cast("array<long>")
    start = anchors.select(*columns, none.alias("caps"), none.alias("floors"))
    found = rungs(
        "positives", start, positive_floors, positives,
        lambda key, label, caps, floors: PositiveSeeker(key, label, positives, floors[0] if floors else None),
        lambda best: F.col("floors").isNull() | (F.col("floors")[0] <= best),
    )
    found = found.select("aid", F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))

    def negative_floors(start: DataFrame, found: DataFrame) -> DataFrame:
        last = found.where(F.col("nth") == negatives).groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("cap", "score"))).alias("last"))
        joined = start.drop("floors").join(last, "aid", "left")
        return joined.withColumn("floors", F.transform("caps", lambda cap: F.col("last")[cap])).drop("last")

    # No score can lie in the band below a negative one.
    caps = found.where("positive_score >= 0").groupBy("aid").agg(F.sort_array(F.collect_set("positive_score"), False).alias("caps"))
    start = anchors.select(*columns).join(caps, "aid").withColumn("floors", F.transform("caps", lambda cap: F.lit(None).cast("long")))
    start = stage(start, folder, "negatives-start")

    def in_reach(best: Column) -> Column:
        pairs = F.arrays_zip("caps", "floors")
        return F.exists(
            pairs,
            lambda p: (F.lit(float(band[0])) * p["caps"] <= F.lit(float(band[1])) * best)
            & (p["floors"].isNull() | (p["floors"] <= best)),
        )

    hard = rungs(
        "negatives", start, negative_floors, negatives,
        lambda key, label, caps, floors: NegativeSeeker(key, label, negatives, caps, floors, band), in_reach,
    )
    out = found.join(
        hard.select("aid", F.col("cap").alias("positive_score"), F.col("score").alias("negative_score"), F.col("key").alias("negative_id"), F.col("nth").alias("rank")),
        ["aid", "positive_score"],
    ).join(anchors.select("aid", F.col("key").alias("anchor_id")), "aid")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
