"""Near-duplicate vectors: spherical k-means cells, blocked cosine products.

Centroids are fitted on a bounded sample; they only decide where vectors meet,
never whether they are linked. A vector belongs to the cell of the centroid
nearest in angle. Two unit vectors whose angle is at most theta and that belong
to cells i and j lie within sin(theta) of the plane that separates the two
centroids, so a vector also visits every later cell whose plane is that near:
no link is lost. Within a label and cell the vectors are dealt into blocks, and
a task compares two blocks by one matrix product in double precision. Equal
vectors of a label are one class, which is compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import settle
from .components import components

#: Vectors the centroids are fitted on, at most about; their rounds.
SAMPLE, ROUNDS = 20_000, 12
#: Classes in a block.
BLOCK = 2048
#: A cell for so many classes, within these bounds.
CLASSES_A_CELL, FEWEST, MOST = 20_000, 4, 1024


def _centroids(vectors: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means; seeds are spread by farthest-first choice."""
    cells = min(cells, len(vectors))
    seeds = [0]
    nearest = vectors @ vectors[0]
    while len(seeds) < cells:
        seeds.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[seeds[-1]])
    centres = vectors[seeds].copy()
    for _ in range(ROUNDS):
        cell = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, vectors)
        length = np.linalg.norm(sums, axis=1)
        moved = length > 1e-9
        centres[moved] = sums[moved] / length[moved, None]
    return np.unique(centres, axis=0)


def _units(batch: pa.RecordBatch, name: str) -> np.ndarray:
    flat = np.frombuffer(b"".join(batch.column(name).to_pylist()), np.float64)
    return flat.reshape(batch.num_rows, -1)


def _fit(classes: DataFrame, cells: int | None) -> dict[int, np.ndarray]:
    """Centroids for every dimension that occurs, from a hashed sample."""
    out = {}
    for row in classes.groupBy("dim").count().collect():
        share = min(1.0, SAMPLE / row["count"])
        some = (classes.where(F.col("dim") == row["dim"])
                .where(F.pmod(F.xxhash64("class"), F.lit(1 << 30)) <= int(share * (1 << 30)))
                .select("unit").orderBy(F.xxhash64("unit")).limit(2 * SAMPLE).toPandas())
        vectors = np.stack([np.frombuffer(v, np.float64) for v in some["unit"]])
        out[row["dim"]] = _centroids(vectors, cells or min(MOST, max(
            FEWEST, row["count"] // CLASSES_A_CELL)))
    return out


def _visits(centres: dict[int, np.ndarray], threshold: float):
    reach = math.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-6 if threshold > 0 else 2.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in set(batch.column("dim").to_pylist()):
                rows = batch.filter(pc.equal(batch.column("dim"), dim))
                vectors, c = _units(rows, "unit"), centres[dim]
                near = vectors @ c.T
                own = near.argmax(axis=1)
                gap = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 1e-30))
                apart = (near[np.arange(len(own)), own][:, None] - near) / gap[own]
                later = np.arange(len(c)) > own[:, None]
                visit = later & (apart <= reach)
                visit[np.arange(len(own)), own] = True
                which, cell = np.nonzero(visit)
                take = pa.array(which)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n).take(take) for n in
                     ("label", "dim", "class", "size", "unit")]
                    + [pa.array(cell.astype(np.int32)), pa.array(own[which] == cell)],
                    ["label", "dim", "class", "size", "unit", "cell", "home"])
    return run


def _compare(threshold: float):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        x = tile[tile["side"] == 0]
        one = tile["b1"].iloc[0] == tile["b2"].iloc[0]
        y = x if one else tile[tile["side"] == 1]
        columns = ["a", "b", "w"]
        if not len(x) or not len(y):
            return pd.DataFrame([], columns=columns)
        ux, uy = (np.stack([np.frombuffer(v, np.float64) for v in s["unit"]])
                  for s in (x, y))
        # Two visitors meet in the cell that one of them belongs to.
        hx, hy = x["home"].to_numpy(bool), y["home"].to_numpy(bool)
        linked = (ux @ uy.T >= threshold) & (hx[:, None] | hy)
        if one:
            np.fill_diagonal(linked, False)
        cx, cy = x["class"].to_numpy(), y["class"].to_numpy()
        rows = [(a, None, int(w)) for a, w in
                zip(cx, linked @ y["size"].to_numpy(np.int64), strict=True) if w]
        if not one:
            rows += [(b, None, int(w)) for b, w in
                     zip(cy, x["size"].to_numpy(np.int64) @ linked, strict=True) if w]
        seen_x, seen_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
        for start in np.flatnonzero(linked.any(axis=1)):
            if seen_x[start]:
                continue
            seen_x[start], todo = True, [(True, start)]
            if one:
                seen_y[start] = True
            while todo:
                left, i = todo.pop()
                near = np.flatnonzero(linked[i] & ~seen_y if left else linked[:, i] & ~seen_x)
                for j in near:
                    rows.append((cx[i], cy[j], 0) if left else (cx[j], cy[i], 0))
                    if one:
                        seen_x[j] = seen_y[j] = True
                    elif left:
                        seen_y[j] = True
                    else:
                        seen_x[j] = True
                    todo.append((one or not left, j))
        return pd.DataFrame(rows, columns=columns)
    return run


def _class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision; null where a vector can have no links."""
    for batch in batches:
        units, dims = [], []
        for v in batch.column("v"):
            unit = None
            values = v.values
            if v.is_valid and len(values) and not values.null_count:
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                scale = np.abs(x).max()
                if np.isfinite(x).all() and scale > 0:
                    x = x / scale
                    unit = x / np.sqrt((x * x).sum())
            units.append(None if unit is None else unit.tobytes())
            dims.append(0 if unit is None else len(unit))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(units, pa.binary()),
             pa.array(dims, pa.int32())], ["id", "label", "unit", "dim"])


_SIGN = -(1 << 63)


def _ordered(id_col: str) -> Column:
    """An id as text that sorts like it, null last."""
    return F.coalesce(F.lpad(F.hex(F.col(id_col).bitwiseXOR(F.lit(_SIGN))), 16, "0"),
                      F.lit("G" * 16))


def _id_of(node: Column) -> Column:
    return F.when(~node.startswith("G"), F.conv(F.substring(node, 1, 16), 16, -10).cast(
        "long").bitwiseXOR(F.lit(_SIGN)))


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93,
                    cells: int | None = None) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors are linked when their labels are equal and not null and their cosine
    is at least ``threshold``. A vector that is null, empty, zero or holds a
    null or non-finite component links with nothing, neither do vectors of
    unequal length. ``component_id`` is the smallest id reachable by links and
    ``kept`` marks its row. Rows that repeat an id are vectors of their own with
    the same id. A null id is reported as null, links like any other and is
    never the component's id where another id is there. Other columns are
    ignored; an empty table gives no rows.
    """
    label = F.to_json(F.struct(F.col(label_col).alias("l")))
    rows = settle(vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(F.col(label_col).isNotNull(), label).alias("label"),
        F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(
            _class_rows, "id bigint, label string, unit binary, dim int"), "units")
    rows = rows.withColumn("class", F.when(
        F.col("unit").isNotNull() & F.col("label").isNotNull(), F.md5(F.concat(
            F.col("label").cast("binary"), F.lit(b"|"), "unit"))))
    classes = settle(rows.where("class is not null").groupBy("class").agg(
        F.first("label").alias("label"), F.first("dim").alias("dim"),
        F.first("unit").alias("unit"), F.count("*").alias("size"),
        F.min("id").alias("id")).withColumn("node", F.concat(_ordered("id"), "class")),
        "vector-classes")
    centres = _fit(classes, cells)
    visits = settle(classes.select("label", "dim", F.col("node").alias("class"), "size",
                                   "unit").mapInArrow(
        _visits(centres, threshold), "label string, dim int, class string, size bigint, "
        "unit binary, cell int, home boolean"), "cells")
    at = ["label", "dim", "cell"]
    blocks = visits.groupBy(*at).agg(F.count("*").alias("held")).withColumn(
        "blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
    # A class goes to every tile of its block: as many as the cell has blocks.
    dealt = visits.join(blocks, at).withColumn("block", F.pmod(
        F.xxhash64("class"), F.col("blocks")).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = dealt.select(
        *at, F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "class", "size",
        "unit", "home")
    found = settle(tiles.groupBy(*at, "b1", "b2").applyInPandas(
        _compare(threshold), "a string, b string, w bigint"), "vector-links")
    gained = found.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("w"))
    groups = components(found.where("b is not null").select("a", "b"))
    # A component goes by its smallest node, and that begins with its smallest id:
    # no class has to meet the others of its component.
    table = (classes.select("class", "node", "size").join(gained, "node", "left")
             .join(groups, "node", "left").select(
        "class", _id_of(F.coalesce("component", "node")).alias("head"),
        (F.col("size") - 1 + F.coalesce("w", F.lit(0))).alias("n")))
    return rows.select("id", "class", "label").join(table, "class", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).alias("n_links"),
        F.coalesce("head", "id").alias("component_id"),
        (F.col("id").eqNullSafe(F.coalesce("head", "id"))).alias("kept"))
