"""Embedding near-dedup by an epsilon grid order join.

For vectors of length 1, cosine >= c means a distance of at most eps = sqrt(2 - 2c). Vectors are projected on their leading principal
axes (a projection never lengthens a distance) and ordered by the cells of a grid of width eps on these axes, leading
axis first. Cut into consecutive intervals, the order has the property that two intervals whose bounding boxes are more than eps
apart on any axis hold no result, and whole runs of the order are skipped at once.

On Spark: equal vectors of a label are one point with a count. Points are range-partitioned in grid order, cut into blocks of
``BLOCK`` points that share label and leading cell, and stored. Boxes of blocks of equal or neighbouring leading cells are compared, and
the pairs that are not provably far come together, one task each. There the two intervals are halved recursively until they are far
apart or small, and small ones are compared in double precision. A block pair gives one row per linked point (how many it links,
and one point it is tied to), never the pairs. A hot cell is many blocks like any other; the number of rows that leave a task is
bounded by its block.

Links count all vectors; components come from the ties. Vectors that are null, zero, or hold null or non-finite components, and those without a
label, link with nothing and are kept; vectors of other lengths never meet. Rows are returned one for one; repeated vec_ids are vectors of their own that
share their id's component. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import components, store

COSINE = 0.98
#: Leading axes of the grid, points of a block, and points below which intervals are compared outright.
AXES, BLOCK, SMALL = 6, 2048, 256
#: Slack for rounding when intervals are skipped; pairs themselves are compared without.
SLACK = 1e-6


def _unit(batch: np.ndarray) -> np.ndarray:
    wide = batch.astype(np.float64)
    # Scaled first, so that squares of very large or small components neither overflow nor vanish.
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def _axes(points: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal axes by vector length, from the second moments of all points (summed in the tasks, then by Spark)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, part in _by_size(batch.column(0)):
                unit = _unit(part[1])
                sums[size] = sums.get(size, 0) + unit.T @ unit
        for size, total in sums.items():
            rows, cols = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(total.size, size, dtype=np.int32)), pa.array(rows.ravel().astype(np.int32)), pa.array(cols.ravel().astype(np.int32)), pa.array(total.ravel())],
                names=["size", "i", "j", "s"],
            )

    moments = points.select("embedding").mapInArrow(run, "size int, i int, j int, s double").groupBy("size", "i", "j").agg(F.sum("s").alias("s"))
    out: dict[int, np.ndarray] = {}
    # The square of the vector length in numbers, whatever the number of vectors.
    for size, part in moments.toPandas().groupby("size"):
        matrix = np.zeros((size, size))
        matrix[part["i"], part["j"]] = part["s"]
        _, axes = np.linalg.eigh((matrix + matrix.T) / 2)
        out[int(size)] = axes[:, ::-1][:, : min(AXES, size)]
    return out


def _by_size(column: pa.Array) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Vectors of equal length together: length, (row numbers, matrix)."""
    sizes = np.asarray(pa.compute.list_value_length(column), dtype=np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        picked = column.take(pa.array(rows))
        yield size, (rows, np.asarray(picked.flatten()).reshape(len(rows), size))


def _with_cells(points: DataFrame, eps: float) -> DataFrame:
    axes = points.sparkSession.sparkContext.broadcast(_axes(points))
    schema = "label int, size int, cells array<int>, id long, copies long, embedding array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            for size, (rows, matrix) in _by_size(column):
                cells = np.floor(_unit(matrix) @ axes.value[size] / eps).astype(np.int32)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(at), pa.array(np.full(len(rows), size, dtype=np.int32)), pa.array(list(cells), pa.list_(pa.int32())), batch.column("id").take(at), batch.column("copies").take(at), column.take(at)],
                    names=["label", "size", "cells", "id", "copies", "embedding"],
                )

    return points.select("label", "id", "copies", "embedding").mapInArrow(run, schema)


_BLOCKS = "block long, label int, size int, lead int, low array<int>, high array<int>, ids binary, copies binary, vectors binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive points of one label, vector length and leading cell."""
    from pyspark import TaskContext

    task, number = TaskContext.get().partitionId(), 0
    held: list[tuple] = []
    key = None

    def block() -> pa.RecordBatch:
        nonlocal number
        cells = np.array([r[3] for r in held], dtype=np.int32)
        row = {
            "block": (task << 32) + number, "label": held[0][0], "size": held[0][1], "lead": int(held[0][3][0]), "low": cells.min(axis=0).tolist(), "high": cells.max(axis=0).tolist(),
            "ids": np.array([r[4] for r in held], dtype=np.int64).tobytes(), "copies": np.array([r[5] for r in held], dtype=np.int64).tobytes(),
            "vectors": np.array([r[6] for r in held], dtype=np.float32).tobytes(),
        }
        number += 1
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("label", "size", "lead", "cells", "id", "copies", "embedding"))):
            if held and (row[:3] != key or len(held) >= BLOCK):
                yield block()
                held = []
            key = row[:3]
            held.append(row)
    if held:
        yield block()


_BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("label", pa.int32()), ("size", pa.int32()), ("lead", pa.int32()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32()))]
    + [(n, pa.binary()) for n in ("ids", "copies", "vectors")]
)


def _join_intervals(a: np.ndarray, b: np.ndarray, same: bool, eps: float, cosine: float, found) -> None:
    """Pairs of rows of two intervals of the order that reach the cosine, handed to ``found`` as two arrays of row numbers.

    ``a`` and ``b`` are (points, projections). Far intervals are skipped, long ones halved; of an interval with itself the halves
    meet each other once.
    """

    def far(x: slice, y: slice) -> bool:
        px, py = a[1][x], b[1][y]
        gap = np.maximum(px.min(axis=0) - py.max(axis=0), py.min(axis=0) - px.max(axis=0))
        return bool((gap > eps + SLACK).any())

    todo = [(0, len(a[0]), 0, len(b[0]), same)]
    while todo:
        x0, x1, y0, y1, self_ = todo.pop()
        if x1 <= x0 or y1 <= y0 or not self_ and far(slice(x0, x1), slice(y0, y1)):
            continue
        if x1 - x0 <= SMALL and y1 - y0 <= SMALL:
            near = a[0][x0:x1] @ b[0][y0:y1].T >= cosine
            if self_:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            if len(i):
                found(i + x0, j + y0)
        elif self_:
            half = (x0 + x1) // 2
            todo += [(x0, half, x0, half, True), (half, x1, half, x1, True), (x0, half, half, x1, False)]
        else:
            xs = [(x0, (x0 + x1) // 2), ((x0 + x1) // 2, x1)] if x1 - x0 > SMALL else [(x0, x1)]
            ys = [(y0, (y0 + y1) // 2), ((y0 + y1) // 2, y1)] if y1 - y0 > SMALL else [(y0, y1)]
            todo += [(*x, *y, False) for x in xs for y in ys]


def _compare(axes: dict[int, np.ndarray] | None, eps: float, cosine: float):
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("tie", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per linked point of a block pair: how many vectors it links there, and one point of its group there."""
        for batch in batches:
            for row in batch.to_pylist():
                same = row["block_a"] == row["block_b"]
                sides = []
                for s in ("a", "a") if same else ("a", "b"):
                    unit = _unit(np.frombuffer(row[f"vectors_{s}"], dtype=np.float32).reshape(-1, row["size"]))
                    sides.append((unit, unit @ axes.value[row["size"]]))
                ids = [np.frombuffer(row[f"ids_{s}"], dtype=np.int64) for s in (("a", "a") if same else ("a", "b"))]
                copies = [np.frombuffer(row[f"copies_{s}"], dtype=np.int64) for s in (("a", "a") if same else ("a", "b"))]
                n = len(ids[0])
                links = [np.zeros(len(x), dtype=np.int64) for x in ids]
                if same:
                    links[1] = links[0]
                up = list(range(n + (0 if same else len(ids[1]))))
                shift = 0 if same else n

                def root(x: int, up: list = up) -> int:
                    while up[x] != x:
                        up[x] = up[up[x]]
                        x = up[x]
                    return x

                def found(i: np.ndarray, j: np.ndarray, links=links, copies=copies, up=up, shift=shift, root=root) -> None:
                    np.add.at(links[0], i, copies[1][j])
                    np.add.at(links[1], j, copies[0][i])
                    # One tie per point and comparison joins a group; the rest of its pairs add nothing.
                    pairs = zip(i.tolist(), (j + shift).tolist())
                    for x, y in pairs:
                        x, y = root(x), root(y)
                        if x != y:
                            up[max(x, y)] = min(x, y)

                _join_intervals(sides[0], sides[1], same, eps, cosine, found)
                every = ids[0] if same else np.concatenate(ids)
                counted = links[0] if same else np.concatenate(links)
                linked = np.flatnonzero(counted)
                if len(linked):
                    roots = np.array([root(x) for x in linked.tolist()])
                    yield pa.RecordBatch.from_arrays([pa.array(every[linked]), pa.array(counted[linked]), pa.array(every[roots])], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label)."""
    eps = math.sqrt(2 - 2 * cosine)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("int").alias("label"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.coalesce(sound & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    own = own.withColumn("usable", usable)
    points = store(own.filter("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "grid_points")
    celled = _with_cells(points, eps).withColumn("lead", F.col("cells")[0])
    order = ["label", "size", *[F.get("cells", F.lit(k)) for k in range(AXES)], "id"]
    ordered = celled.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = store(ordered.select("label", "size", "lead", "cells", "id", "copies", "embedding").mapInArrow(_cut, _BLOCKS), "grid_blocks")

    boxes = blocks.select("block", "label", "size", "lead", "low", "high")
    ahead = boxes.withColumn("lead", F.explode(F.array("lead", F.col("lead") + 1)))
    apart = F.exists(
        F.arrays_zip(F.col("a.low").alias("al"), F.col("a.high").alias("ah"), F.col("b.low").alias("bl"), F.col("b.high").alias("bh")),
        lambda z: (z["bl"] - z["ah"] > 1) | (z["al"] - z["bh"] > 1),
    )
    near = (
        ahead.alias("a").join(boxes.alias("b"), ["label", "size", "lead"])
        .filter((F.col("a.high")[0] < F.col("lead")) | (F.col("a.block") <= F.col("b.block"))).filter(~apart)
        .select("size", F.col("a.block").alias("block_a"), F.col("b.block").alias("block_b"))
    )
    side = lambda s: blocks.select(F.col("block").alias(f"block_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "vectors")])
    axes = vectors.sparkSession.sparkContext.broadcast(_axes(points))
    paired = near.join(side("a"), "block_a").join(side("b"), "block_b")
    found = store(paired.mapInArrow(_compare(axes, eps, cosine), "id long, links long, tie long"), "grid_links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("tie").alias("b")))
    tied = points.join(links, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left").filter("copies > 1 or links is not null")
    named = store(tied.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "id").alias("component")), "grid_named")
    joined = own.alias("o").join(named.alias("n"), (F.col("o.label") == F.col("n.label")) & (F.col("o.embedding") == F.col("n.embedding")) & F.col("usable"), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )
