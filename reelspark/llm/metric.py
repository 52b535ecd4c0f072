"""Near copies among embeddings: an exact range join around pivots.

On the unit sphere a least cosine is a largest distance. Pivots, taken from a bounded
sample, divide the vectors: each has its home in the cell of its nearest pivot. By the
triangle inequality a vector can be in range of a cell's home vectors only if it lies
within the range of the cell's radius, and not farther than the range beyond the plane
that divides the two pivots; it visits all such cells. So each home vector meets
everything in range inside its own cell, and cells join independently.

Cells with many vectors are cut into rings by the distance to the pivot. Rings whose
distances differ by more than the range cannot meet; rings whose distances add up to no
more than the range are linked as a whole, by their counts alone; the others are compared
in blocks of bounded size. A dense group, even of a third of all rows, thus costs no pair
where it is narrower than half the range, and elsewhere its blocks are spread over tasks.
Blocks return the number of links of each vector and a spanning set of links, never
pairs. How many pivots there are is weighed on the sample: with more, cells are smaller,
but vectors visit more of them. It decides work, never results.

Equal vectors of a label are one vector with a count until the end.

Defined cases: vectors that are null, empty, zero, of another length than most, or that
hold a null or non-finite component, and all vectors without a label, link with nothing;
every row has its row in the result, and rows that repeat an id are vectors of their own.
Rows without an id link too, but no id comes from them: where none is reachable the
component is null, and kept tells whether id and component are the same, null included.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import sliced, written
from reelspark.llm.graph import components
from reelspark.operators.spread import lookup_join

LIMIT = 0.93
#: Vectors of the sample that pivots come from, numbers of pivots that are weighed, and
#: the bytes that the sample may have.
SAMPLE, CHOICES, SAMPLE_BYTES = 2048, (1, 4, 16, 64, 256, 1024), 1 << 25
#: Vectors of each side that are compared at a time, on average; larger cells have rings.
BLOCK = 1024
#: Rings that the range is wide.
RINGS = 4
#: What rounding may do to a distance.
SLACK = 1e-6
#: Cosines this close to the limit are computed anew, alike for both orders of a pair.
CLOSE = 1e-9
#: Weights of the choice of pivots: seconds to move a vector, and to compare a pair.
MOVE, PAIR = 2e-5, 2e-8


def flagged(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding, and whether the vector can link."""
    kind = dict(vectors.select("embedding").dtypes)["embedding"]
    wanted = "array<float>" if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast(wanted).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0.0)
    rows = rows.withColumn("fit", sound)
    common = rows.where("fit").groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = common["n"] if common else 0
    return rows.withColumn("fit", F.col("fit") & (F.size("embedding") == length))


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


@dataclass(frozen=True)
class Cells:
    """Pivots, and the distance of the farthest home vector from each."""

    pivots: np.ndarray
    reach: float
    radius: np.ndarray

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to all pivots, and the place of the nearest."""
        far = _distances(x, self.pivots)
        return far, far.argmin(axis=1)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances, homes, and for each row and cell whether the row belongs there."""
        far, home = self.homes(x)
        near = far[np.arange(len(x)), home]
        between = np.maximum(_distances(self.pivots, self.pivots), 1e-12)[home]
        beyond = (far**2 - near[:, None] ** 2) / (2 * between)
        at = (far <= self.radius + self.reach + SLACK) & (beyond <= self.reach + SLACK)
        at[np.arange(len(x)), home] = True
        return far, home, at


def choose(sample: np.ndarray, reach: float, rows: int, share: float) -> np.ndarray:
    """The pivots of least estimated cost. ``share``: of all pairs of vectors, those of
    one label."""
    pivots, held = sample[::2], sample[1::2] if len(sample) > 1 else sample
    best = None
    for count in CHOICES:
        if count > max(1, len(pivots)):
            break
        cells = Cells(pivots[:count], reach, np.full(count, np.inf))
        far, home = cells.homes(held)
        radius = np.full(count, -np.inf)
        np.maximum.at(radius, home, far[np.arange(len(held)), home])
        _, _, at = Cells(pivots[:count], reach, radius).visits(held)
        compared = (np.bincount(home, minlength=count) / len(held) * at.mean(axis=0)).sum()
        blocks = max(1, rows * share * compared / BLOCK)
        cost = rows * at.sum(axis=1).mean() * blocks * MOVE + rows**2 * share * compared * PAIR
        if best is None or cost < best[0]:
            best = (cost, cells.pivots)
    return best[1]


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def placed(classes: DataFrame, cells: Cells, dims: int) -> DataFrame:
    """Each vector in its home and in the cells it visits."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(iter([batch])):
                raw = _vectors(part, dims)
                far, home, at = cells.visits(units(raw))
                who, where = np.nonzero(at)
                blobs = [r.tobytes() for r in raw]
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": part["label"].take(pa.array(who)),
                        "cell": pa.array(where, pa.int32()),
                        "node": part["node"].take(pa.array(who)),
                        "rows": part["rows"].take(pa.array(who)),
                        "home": pa.array(home[who] == where),
                        "dist": far[who, where],
                        "vector": pa.array([blobs[i] for i in who], pa.binary()),
                    }
                )

    label = classes.schema["label"].dataType.simpleString()
    names = f"label {label}, cell int, node long, rows long, home boolean, dist double, vector binary"
    return written(classes.select("label", "node", "rows", "embedding").mapInArrow(place, names), "cells")


def _radius(classes: DataFrame, pivots: np.ndarray, reach: float, dims: int) -> Cells:
    open_cells = Cells(pivots, reach, np.full(len(pivots), np.inf))

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.full(len(pivots), -np.inf)
        for batch in batches:
            for part in sliced(iter([batch])):
                far, home = open_cells.homes(units(_vectors(part, dims)))
                np.maximum.at(most, home, far[np.arange(len(home)), home])
        at = np.flatnonzero(most > -np.inf)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(at, pa.int32()), "dist": most[at]})

    found = classes.select("embedding").mapInArrow(widest, "cell int, dist double").groupBy("cell").agg(F.max("dist")).collect()
    radius = np.full(len(pivots), -np.inf)
    for cell, dist in found:
        radius[cell] = dist
    return Cells(pivots, reach, radius)


def _exact(u: np.ndarray, v: np.ndarray) -> float:
    return math.fsum((u * v).tolist())


def linked(u: np.ndarray, v: np.ndarray, limit: float) -> np.ndarray:
    """Which rows of two blocks of unit vectors are in range."""
    cosine = u @ v.T
    near = cosine >= limit
    for i, j in zip(*np.nonzero(np.abs(cosine - limit) < CLOSE)):
        near[i, j] = _exact(u[i], v[j]) >= limit
    return near


def spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a block of links, the least place of their
    component: rows count first, columns after them."""
    n, m = near.shape
    rows, columns, none = np.arange(n), np.arange(n, n + m), n + m
    while True:
        least = np.minimum(rows, np.where(near, columns, none).min(axis=1, initial=none))
        lower = np.minimum(columns, np.where(near, least[:, None], none).min(axis=0, initial=none))
        if (least == rows).all() and (lower == columns).all():
            return rows, columns
        rows, columns = least, lower


def near_copies(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = flagged(vectors)
    key = ["label", "embedding"]
    classes = rows.where("fit").groupBy(*key).agg(F.count("*").alias("rows"), F.min("vec_id").alias("least"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    first = classes.select(F.size("embedding")).first()
    alone = rows.where(~F.coalesce("fit", F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if first is None:
        return alone
    dims, reach = first[0], math.sqrt(2 - 2 * limit)
    links, sure = _joined(classes, dims, reach, limit)
    counted = links.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    found = lookup_join(classes, counted, ["node"], "left")
    found = lookup_join(found, sure, ["node"], "left")
    found = written(lookup_join(found, roots, ["node"], "left").select(
        *key,
        "least",
        F.coalesce("root", "node").alias("root"),
        (F.col("rows") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce("sure", F.lit(0))).alias("n_links"),
    ), "linked")
    lowest = found.groupBy("root").agg(F.min("least").alias("component_id"))
    found = lookup_join(found, lowest, ["root"])
    members = lookup_join(rows.where("fit").select("vec_id", *key), found.select(*key, "n_links", "component_id"), key)
    return members.select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    ).union(alone)


def _joined(classes: DataFrame, dims: int, reach: float, limit: float) -> tuple[DataFrame, DataFrame]:
    """Links: (node, null, number of rows linked in one block) and (node, other, null),
    a spanning set; and (node, sure), the rows linked without comparing."""
    kind = "<f4" if classes.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    held = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))
    sample = classes.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(held).collect()
    sample = units(np.array([r[0] for r in sample], dtype=np.float64))
    sizes = classes.groupBy("label").agg(F.count("*").cast("double").alias("n"))
    total = sizes.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("s")).first()
    pivots = choose(sample, reach, int(total["n"]), total["s"] / total["n"] ** 2)
    cells = _radius(classes, pivots, reach, dims)
    rows = placed(classes, cells, dims)

    spot, ring = ["label", "cell"], F.floor(F.col("dist") / (reach / RINGS)).cast("int")
    crowd = rows.groupBy(*spot).agg(F.count("*").alias("_n"))
    rows = lookup_join(rows, crowd, spot).withColumn("ring", F.when(F.col("_n") > BLOCK, ring).otherwise(0)).drop("_n")
    home = F.col("home")
    tiles = written(rows.groupBy(*spot, "ring").agg(
        F.count("*").alias("all"), F.sum("rows").alias("weight"), F.min("node").alias("rep"),
        F.min("dist").alias("low"), F.max("dist").alias("high"),
        F.count_if(home).alias("homes"), F.min(F.when(home, F.col("node"))).alias("home_rep"),
        F.min(F.when(home, F.col("dist"))).alias("home_low"), F.max(F.when(home, F.col("dist"))).alias("home_high"),
    ), "rings")
    # a cell has a few dozen rings at most, whatever it holds
    asks = tiles.where("homes > 0").select(*spot, F.col("ring").alias("ra"), "homes", "home_rep", "home_low", "home_high")
    pairs = asks.join(tiles.select(*spot, F.col("ring").alias("rb"), "all", "weight", "rep", "low", "high"), spot)
    pairs = pairs.where((F.col("low") - F.col("home_high") <= reach + SLACK) & (F.col("home_low") - F.col("high") <= reach + SLACK))
    whole = F.col("home_high") + F.col("high") <= reach - SLACK
    pairs = written(pairs.withColumn("whole", whole), "pairs")

    # rings that are linked as a whole
    own = F.when(F.col("ra") == F.col("rb"), 1).otherwise(0)
    whole_a = pairs.where("whole").groupBy(*spot, F.col("ra").alias("ring")).agg(
        F.sum("weight").alias("_weight"), F.max(own).alias("_own"), F.first("home_rep").alias("_rep")
    )
    inside = lookup_join(rows.where("home").select(*spot, "ring", "node", "rows"), whole_a, [*spot, "ring"])
    sure = inside.select("node", (F.col("_weight") - F.col("_own") * F.col("rows")).alias("sure"))
    whole_b = pairs.where("whole").select(*spot, F.col("rb").alias("ring"), F.col("rep").alias("_rep")).distinct()
    across = lookup_join(rows.select(*spot, "ring", "node"), whole_b, [*spot, "ring"])
    star = inside.select("node", F.col("_rep").alias("other")).union(across.select("node", F.col("_rep").alias("other")))
    star = star.union(pairs.where("whole").select("home_rep", "rep")).where("node <> other")

    # the others are compared in blocks
    rest = pairs.where(~F.col("whole")).select(
        *spot, "ra", "rb", F.ceil(F.col("homes") / BLOCK).cast("int").alias("na"), F.ceil(F.col("all") / BLOCK).cast("int").alias("nb")
    )
    part = F.xxhash64("node")
    block = ["label", "cell", "ra", "pa", "rb", "pb"]
    left = lookup_join(rows.where("home").withColumnRenamed("ring", "ra"), rest, [*spot, "ra"]).select(
        *spot, "ra", "rb", "node", "rows", "vector", F.lit(True).alias("asks"),
        F.pmod(part, F.col("na")).cast("int").alias("pa"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("pb"),
    )
    right = lookup_join(rows.withColumnRenamed("ring", "rb"), rest, [*spot, "rb"]).select(
        *spot, "ra", "rb", "node", "rows", "vector", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("pa"), F.pmod(part, F.col("nb")).cast("int").alias("pb"),
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = pa.Table.from_batches(list(batches)).combine_chunks()
        side = parts["asks"].to_numpy(zero_copy_only=False).astype(bool)
        nodes, weight = parts["node"].to_numpy(), parts["rows"].to_numpy()
        blob = b"".join(parts["vector"].to_pylist())
        x = units(np.frombuffer(blob, dtype=kind).reshape(-1, dims))
        near = linked(x[side], x[~side], limit) & (nodes[side][:, None] != nodes[~side][None, :])
        links = near @ weight[~side]
        some = links > 0
        every = np.concatenate([nodes[side], nodes[~side]])
        node, other = nodes[side][some], np.empty(0, dtype=np.int64)
        if some.any():
            least = np.concatenate(spanning(near))
            moved = least != np.arange(len(every))
            node, other = np.concatenate([node, every[moved]]), every[least[moved]]
        size = int(some.sum())
        yield pa.RecordBatch.from_pydict(
            {
                "node": node,
                "other": pa.array([None] * size + other.tolist(), pa.int64()),
                "links": pa.array(links[some].tolist() + [None] * len(other), pa.int64()),
            }
        )

    found = left.union(right).groupBy(*block).applyInArrow(compare, "node long, other long, links long")
    star = star.select("node", "other", F.lit(None).cast("long").alias("links"))
    return written(found.union(star), "links"), written(sure, "sure")
