"""Centroid clustering with adaptive distance bounds, in exact whole-number arithmetic.

Vectors become whole numbers once. Each round every vector keeps, beside its centroid and an upper bound of its distance, lower bounds of
the distances to its next nearest centroids, in order, and one bound for all the rest. When centroids move, the upper bound grows and the
lower bounds shrink by how far theirs moved. While the upper bound is below all lower bounds nothing is computed; where it is below those
from some place on, only the centroids before that place are measured and put in order again; otherwise all are. Bounds are floating-point
numbers with a margin, distances that decide are exact, and a tie is never certified, so the result is that of measuring everything. The
number of bounds starts at a quarter of the centroids and falls to what the last round needed.

A round writes the vectors with their bounds to the shared folder and adds up what the vectors that changed their centroid bring and take;
centroids, a few numbers, pass through the driver.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import delete_tables, in_parts, quoted, shared_folder, ship_code, written

#: Components of a vector, centroids and rounds of the query; components are cut to this many parts of one.
DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Rows measured at a time.
ROWS = 20_000
#: Relative margin of bounds: far above the error of a few dozen additions, far below what separates centroids.
MARGIN = 1e-9
#: Up to this size of components sums of squares are exact in floating point, and up to the next in 64 bits.
EXACT_FLOAT, EXACT_LONG = 2**22, 2**27
#: Components beyond this count as this, distances beyond the second as the second.
LARGEST, LONGEST = 2**62, 2**63 - 1


class Measure:
    """Exact squared distances of whole-number vectors from centroids."""

    def __init__(self, centroids: list[list[int]], largest: int):
        largest = max([largest, *(abs(x) for c in centroids for x in c)], default=0)
        self.kind = np.float64 if largest <= EXACT_FLOAT else np.int64 if largest <= EXACT_LONG else object
        self.centroids = np.array(centroids, dtype=self.kind)
        self.squares = (self.centroids * self.centroids).sum(axis=1)

    def prepared(self, x: np.ndarray) -> np.ndarray:
        return x.astype(self.kind)

    def all(self, x: np.ndarray) -> np.ndarray:
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ self.centroids.T) + self.squares[None, :]

    def some(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Of each vector to those of its row in `which`."""
        return np.stack([((x - self.centroids[which[:, j]]) ** 2).sum(axis=1) for j in range(which.shape[1])], axis=1)


def roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def in_order(distances: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances and centroids of each row, nearest first, of ties the smaller number."""
    if distances.dtype == object:
        at = np.array([sorted(range(len(d)), key=lambda j: (d[j], w[j])) for d, w in zip(distances.tolist(), which.tolist(), strict=True)], dtype=np.int64).reshape(distances.shape)
    else:
        at = np.lexsort((which, distances), axis=1)
    return np.take_along_axis(distances, at, 1), np.take_along_axis(which, at, 1)


class Bounds:
    """One round's assignment: `near` are centroids, the own one first, `upper` the own distance's bound, `lower` the bounds of the others
    in near and, last, of all the rest."""

    def __init__(self, measure: Measure, moved: list[float] | None, bounds: int):
        self.measure, self.bounds = measure, bounds
        self.moved = None if moved is None else np.array(moved)

    def first(self, x: np.ndarray):
        n, k = len(x), len(self.measure.centroids)
        d, which = in_order(self.measure.all(x), np.tile(np.arange(k, dtype=np.int64), (n, 1)))
        keep = min(self.bounds, k - 1)
        r = roots(d)
        rest = r[:, keep + 1] if keep + 1 < k else np.full(n, np.inf)
        lower = np.concatenate([r[:, 1 : keep + 1], rest[:, None]], axis=1) * (1 - MARGIN)
        return which[:, : keep + 1], r[:, 0] * (1 + MARGIN), lower

    def next(self, x, near: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        """The same after the centroids moved, and the number of places that the round needed."""
        kept = min(near.shape[1] - 1, self.bounds)
        if kept < near.shape[1] - 1:  # fewer bounds than before: the last ones join the rest
            lower = np.concatenate([lower[:, :kept], lower[:, kept:].min(axis=1, keepdims=True)], axis=1)
            # A bound in the rest falls by the largest movement, so its own is not needed any more.
            near = near[:, : kept + 1]
        upper = (upper + self.moved[near[:, 0]]) * (1 + MARGIN)
        falls = np.concatenate([self.moved[near[:, 1:]], np.full((len(near), 1), self.moved.max())], axis=1)
        lower = (lower - falls) * np.where(lower > falls, 1 - MARGIN, 1 + MARGIN)
        # Each place bounds itself and all behind it.
        lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
        certain = upper[:, None] < lower
        place = np.where(certain.any(axis=1), certain.argmax(axis=1), kept + 1)  # so many of the others have to be measured
        near, upper, lower = near.copy(), upper.copy(), lower.copy()
        for z in np.unique(place[place > 0]).tolist():
            rows = np.flatnonzero(place == z)
            part = self.measure.prepared(x[rows])
            if z > kept:
                near[rows], upper[rows], lower[rows] = self.first(part)
                continue
            d, which = in_order(self.measure.some(part, near[rows, : z + 1]), near[rows, : z + 1])
            r = roots(d)
            near[rows, : z + 1], upper[rows] = which, r[:, 0] * (1 + MARGIN)
            lower[rows[:, None], np.arange(z)[None, :]] = r[:, 1:] * (1 - MARGIN)
        return near, upper, lower, int(place.max(initial=0))


def vectors_of(column: pa.Array, wide: bool) -> np.ndarray:
    """Stored vectors as an array, (rows, components); wide ones are decimal strings."""
    if wide:
        return np.array([[int(v) for v in x.split(",")] for x in column.to_pylist()], dtype=object).reshape(len(column), -1)
    n = len(column)
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<i4").reshape(n, -1) if n else np.zeros((0, 0), np.int32)


def whole_numbers(df: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, v) of the vectors that are kept; v is an array of exact decimals."""
    x = F.col(quoted(vector_col))
    fits = (F.size(x) == dimensions) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    limit = float(LARGEST)
    cut = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), F.lit(float(scale)) * v.cast("double")))).cast("long"))
    return df.where(F.coalesce(fits, F.lit(False))).select(F.col(quoted(id_col)).alias("vec_id"), cut.alias("v"))


def stored(kept: DataFrame, wide: bool) -> DataFrame:
    """Vectors in the form that rounds carry: packed 32-bit numbers, or text where one is beyond them."""
    if wide:
        return kept.select("vec_id", F.array_join(F.col("v").cast("array<string>"), ",").alias("x"))
    kind = kept.schema["vec_id"].dataType

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            values = np.ascontiguousarray(batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i4"))
            size = values.nbytes // n if n else 0
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * size)
            packed = pa.Array.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(values.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed], ["vec_id", "x"])

    return kept.mapInArrow(run, T.StructType([T.StructField("vec_id", kind), T.StructField("x", T.BinaryType())]))


def floored(total: int, count: int) -> int:
    return total // count


def clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = "3:") -> tuple[DataFrame, list[list[int]], list[int]]:
    """(assignment, centroids, bounds used in each round); the assignment has vec_id, cluster, distance (squared) and moved_in, the number of
    the last round that changed its cluster.

    Vectors of another length, with a null or with a component that is not finite are not kept, and neither is a null vector. Components are
    floor(scale * x), beyond 2^62 that. Centroids start as the k kept vectors with the smallest SHA-256 of seed and id (null: empty; of equal
    ids the vector with the smaller components), fewer if fewer are kept. Ties of distance go to the smaller number; a centroid without
    vectors stays where it is. Distances beyond 64 bits are the largest 64-bit number. Rows that repeat are repeated; other columns are not
    read; an empty table gives an empty result."""
    spark = df.sparkSession
    ship_code(spark)
    folder = shared_folder(spark)
    kept = whole_numbers(df, id_col, vector_col, dimensions, scale)
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    starts = kept.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    largest = kept.select(F.max(F.array_max(F.transform("v", lambda v: F.greatest(v, -v)))).alias("m")).first()["m"] or 0
    schema = "vec_id {}, cluster int, distance long, moved_in int".format(kept.schema["vec_id"].dataType.simpleString())
    if not starts:
        return spark.createDataFrame([], schema), [], []
    wide = largest >= 2**31
    centroids = [list(r["v"]) for r in starts]
    data = written(stored(kept, wide), folder, "vectors")
    totals, counts = [[0] * dimensions for _ in centroids], [0] * len(centroids)
    bounds, used, moved = max(1, len(centroids) // 4), [], None
    state = data
    for number in range(rounds + 1):
        state = written(assigned(state, centroids, moved, bounds, number, largest, wide), folder, f"state-{number}")
        used.append(bounds)
        delete_tables(spark, folder, f"state-{number - 1}" if number else "vectors")
        if number == rounds:
            break
        needed = 1
        for cluster, at, total, places in changes(state, number, wide).collect():
            if at < 0:
                counts[cluster] += int(total)
            else:
                totals[cluster][at] += int(total)
            needed = max(needed, places or 0)
        if number:  # the number of bounds falls to what was needed, at most by half
            bounds = max(1, len(centroids) // 8, min(bounds, needed))
        before = centroids
        centroids = [[floored(t, counts[c]) for t in totals[c]] if counts[c] else centroids[c] for c in range(len(centroids))]
        moved = [float(np.sqrt(float(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))))) * (1 + MARGIN) for x, y in zip(before, centroids, strict=True)]
    return measured(state, centroids, largest, wide), centroids, used


STATE = (("cluster", T.IntegerType()), ("was", T.IntegerType()), ("moved_in", T.IntegerType()), ("places", T.IntegerType()), ("near", T.ArrayType(T.IntegerType())), ("upper", T.DoubleType()), ("lower", T.ArrayType(T.DoubleType())))


def assigned(state: DataFrame, centroids: list[list[int]], moved: list[float] | None, bounds: int, number: int, largest: int, wide: bool) -> DataFrame:
    """The state after an assignment. `was` is the cluster before, null in the first round; `places` the number of others that were measured
    for the batch of the row at most."""
    schema = T.StructType([*state.schema.fields[:2], *(T.StructField(n, t) for n, t in STATE)])

    def run(batches):
        bound = Bounds(Measure(centroids, largest), moved, bounds)
        for whole in batches:
            for batch in in_parts(whole, ROWS):
                n = batch.num_rows
                x = vectors_of(batch.column("x"), wide)
                if moved is None:
                    near, upper, lower = bound.first(bound.measure.prepared(x))
                    was, since, places = pa.nulls(n, pa.int32()), np.zeros(n, np.int32), 0
                else:
                    old = batch.column("cluster").to_numpy(zero_copy_only=False)
                    shaped = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)  # noqa: B023, E731
                    near, upper, lower, places = bound.next(x, shaped("near").astype(np.int64), batch.column("upper").to_numpy(), shaped("lower"))
                    was = pa.array(old, pa.int32())
                    since = np.where(near[:, 0] != old, number, batch.column("moved_in").to_numpy(zero_copy_only=False))
                lists = lambda a, kind: pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel(), kind))  # noqa: B023, E731
                columns = [batch.column("vec_id"), batch.column("x"), pa.array(near[:, 0].astype(np.int32)), was, pa.array(since.astype(np.int32)), pa.array(np.full(n, places, np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, lists(near.astype(np.int32), pa.int32()), pa.array(upper), lists(lower, pa.float64())], schema.names)

    return state.mapInArrow(run, schema)


def changes(state: DataFrame, number: int, wide: bool) -> DataFrame:
    """(cluster, at, total, places): what the vectors that changed their cluster add to the sums of its components and, at -1, to its count;
    added up in every task before the shuffle."""

    def run(batches):
        for whole in batches:
            for batch in in_parts(whole, ROWS):
                x = vectors_of(batch.column("x"), wide)
                x = x.astype(object if wide else np.int64)
                rows = []
                for name, sign in (("cluster", 1), ("was", -1)):
                    where = pc.fill_null(batch.column(name), -1).to_numpy()
                    for c in np.unique(where[where >= 0]).tolist():
                        mine = x[where == c]
                        rows += [(c, -1, Decimal(sign * len(mine))), *((c, at, Decimal(sign * int(t))) for at, t in enumerate(mine.sum(axis=0)))]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.decimal128(38, 0))], ["cluster", "at", "total"])

    new = state.where("was is null or was <> cluster").select("x", "cluster", "was").mapInArrow(run, "cluster int, at int, total decimal(38,0)")
    sums = new.groupBy("cluster", "at").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.lit(0).alias("places"))
    needed = state.agg(F.max("places").alias("places")).select(F.lit(0).alias("cluster"), F.lit(-1).alias("at"), F.lit(0).cast("decimal(38,0)").alias("total"), F.coalesce("places", F.lit(0)).alias("places"))
    return sums.unionByName(needed)


def measured(state: DataFrame, centroids: list[list[int]], largest: int, wide: bool) -> DataFrame:
    """The last assignment with exact distances."""
    schema = T.StructType([state.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()), T.StructField("moved_in", T.IntegerType())])

    def run(batches):
        measure = Measure(centroids, largest)
        for whole in batches:
            for batch in in_parts(whole, ROWS):
                x = measure.prepared(vectors_of(batch.column("x"), wide))
                cluster = batch.column("cluster")
                d = measure.some(x, cluster.to_numpy().astype(np.int64)[:, None])[:, 0] if len(x) else np.zeros(0)
                d = pa.array([min(int(v), LONGEST) for v in d.tolist()], pa.int64()) if d.dtype == object else pa.array(d.astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), cluster, d, batch.column("moved_in")], schema.names)

    return state.select("vec_id", "x", "cluster", "moved_in").mapInArrow(run, schema)


def cluster_report(df: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector (see clusters); sums beyond 64 bits are
    the largest 64-bit number."""
    spark = df.sparkSession
    found, centroids, _ = clusters(df, **options)
    rows = written(found, shared_folder(spark), "assignment") if centroids else found
    within = lambda c: F.least(c, F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("decimal(38,0)").alias("s")).collect()}
    hashes = [(c, Decimal(sums.get(c, 0)), Decimal(sum(sums.values())), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    table = spark.createDataFrame(hashes, "cluster int, s decimal(38,0), t decimal(38,0), centroid_sha256 string")
    # One row for a centroid.
    told = rows.join(F.broadcast(table), "cluster")
    return told.select("vec_id", "cluster", "distance", within(F.col("s")).alias("cluster_inertia"), within(F.col("t")).alias("inertia"), "centroid_sha256", "moved_in")
