"""Near-duplicate vectors: int8 tile products with rigorous error bounds, exact where they leave doubt."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import numbered, stored, with_components, working_columns

#: Vectors a tile holds on average, and tiles one task compares a tile with.
TILE = 4_096
PARTNERS = 8
#: Most directions the vectors are sorted by; they are the one thing that passes the driver.
MOST_PIVOTS = 1_024
#: Rows of a tile multiplied at once.
STRIP = 512
#: Longest run of dimensions whose int8 products float32 adds up exactly: 127 * 127 * 1024 < 2 ** 24.
EXACT_RUN = 1_024
#: What rounding in double precision may add to a bound.
SLACK = 1e-9

TILE_SCHEMA = "tile LONG, dim INT, n INT, center BINARY, radius DOUBLE, ids BINARY, copies BINARY, vectors BINARY"


def _keyed(kind: str):
    """Adds a digest of the vector; rows whose vector links with nothing get null."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column("id"), batch.column("vector")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)  # nulls become NaN
            sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(vectors).to_pylist()])
            keys, dims, data, at = [], [], [], 0
            for size, known in zip(sizes.tolist(), pa.compute.is_valid(ids).to_pylist()):
                vector = flat[at : at + size] + 0.0  # one form of zero
                at += size
                good = known and size and bool(np.isfinite(vector).all()) and bool(vector.any())
                raw = vector.tobytes() if good else None
                keys.append(hashlib.md5(raw).digest() if good else None)
                data.append(raw)
                dims.append(size)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(data, pa.binary())],
                ["id", "key", "dim", "vector"],
            )

    return add


def _units(vectors: np.ndarray) -> np.ndarray:
    rows = vectors.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # keeps squares of huge or tiny values finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    return _units(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1))


def _nearest(kind: str, pivots: dict[int, np.ndarray]):
    """Adds the pivot of the same dimension that a vector is nearest to."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = _unit(batch.column("vector").take(pa.array(at)).to_pylist(), kind)
                cells[at] = (rows @ pivots[dim].T).argmax(axis=1) if dim in pivots else 0
            yield batch.append_column("cell", pa.array(cells))

    return add


def _tile(kind: str):
    """A tile's vectors in one row, with the cone that holds them."""

    def build(group: pa.Table) -> pa.Table:
        rows = _unit(group["vector"].to_pylist(), kind)
        center = rows.sum(axis=0)
        length = np.linalg.norm(center)
        center = center / length if length > 1e-12 else rows[0]
        radius = float(np.arccos(np.clip(rows @ center, -1, 1)).max())
        return pa.table({
            "tile": [group["tile"][0].as_py()], "dim": pa.array([rows.shape[1]], pa.int32()),
            "n": pa.array([len(rows)], pa.int32()), "center": [center.tobytes()], "radius": [radius],
            "ids": [group["node"].to_numpy().astype("<i8").tobytes()],
            "copies": [group["copies"].to_numpy().astype("<i8").tobytes()],
            "vectors": [b"".join(group["vector"].to_pylist())],
        })

    return build


def _close(threshold: float):
    """Pairs of tiles that may hold a link: cones within the threshold's angle of each other."""
    reach = math.acos(threshold) + 1e-6

    def find(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for dim in set(left["dim"].to_pylist()):
            a = left.filter(pa.compute.equal(left["dim"], dim))
            b = right.filter(pa.compute.equal(right["dim"], dim))
            if not len(b):
                continue
            centers = [np.frombuffer(b"".join(t["center"].to_pylist()), "<f8").reshape(len(t), -1) for t in (a, b)]
            angles = np.arccos(np.clip(centers[0] @ centers[1].T, -1, 1))
            tiles_a, tiles_b = a["tile"].to_numpy(), b["tile"].to_numpy()
            near = angles <= reach + a["radius"].to_numpy()[:, None] + b["radius"].to_numpy()[None, :]
            i, j = np.nonzero(near & (tiles_a[:, None] <= tiles_b[None, :]))
            out[0].append(tiles_a[i])
            out[1].append(tiles_b[j])
        return pa.table({"tile": np.concatenate(out[0]), "partner": np.concatenate(out[1])})

    return find


class _Quantised:
    """Unit vectors, their int8 forms and how far those may be off."""

    def __init__(self, row: dict, kind: str) -> None:
        self.tile = row["tile"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.copies = np.frombuffer(row["copies"], "<i8")
        self.unit = _units(np.frombuffer(row["vectors"], kind).reshape(len(self.ids), -1))
        self.scale = np.abs(self.unit).max(axis=1) / 127
        self.codes = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        whole = self.codes * self.scale[:, None]
        self.error = np.linalg.norm(self.unit - whole, axis=1)
        self.length = np.linalg.norm(whole, axis=1)
        self.exact = self.codes.astype(np.float32)


def _code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 codes, held as float32 and therefore fast, and exact."""
    if a.shape[1] <= EXACT_RUN:
        return a @ b.T
    return sum(
        (a[:, k : k + EXACT_RUN] @ b[:, k : k + EXACT_RUN].T).astype(np.float64) for k in range(0, a.shape[1], EXACT_RUN)
    )


def tile_links(a: _Quantised, b: _Quantised, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Strips ``(first row, links)`` of the boolean matrix of pairs with cosine >= ``threshold``.

    With x = s q + e, the product of x and y differs from the scaled product of codes by at most
    |e_x| |s q_y| + |s q_x| |e_y| + |e_x| |e_y|. Pairs that stay below the threshold with all of
    this added are no links; all others are multiplied in double precision.
    """
    for first in range(0, len(a.ids), STRIP):
        strip = slice(first, first + STRIP)
        products = _code_products(a.exact[strip], b.exact)
        # one limit per row, by the least favourable column, discards nearly everything
        worst = a.error[strip] * b.length.max() + (a.length[strip] + a.error[strip]) * b.error.max()
        limit = (threshold - worst - SLACK) / a.scale[strip]
        limit = np.where(limit > 0, limit / b.scale.max(), limit / b.scale.min())
        i, j = np.nonzero(products >= (limit - 1)[:, None])
        links = np.zeros(products.shape, bool)
        if len(i) * 20 > products.size:
            links = a.unit[strip] @ b.unit.T >= threshold
        elif len(i):
            rows = i + first
            bound = a.scale[rows] * b.scale[j] * products[i, j] + a.error[rows] * b.length[j]
            bound += (a.length[rows] + a.error[rows]) * b.error[j]
            possible = bound >= threshold - SLACK
            i, j, rows = i[possible], j[possible], rows[possible]
            sure = np.einsum("ij,ij->i", a.unit[rows], b.unit[j]) >= threshold
            links[i[sure], j[sure]] = True
        yield first, links


def _roots(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Labels after joining the pairs ``(a, b)``: the smallest label each place can reach."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def _compare(kind: str, threshold: float):
    """Link counts and a root per linked vector, for one tile and some partners."""

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        own = _Quantised(left.to_pylist()[0], kind)
        ids, counts, roots = [], [], []
        for row in right.to_pylist():
            other = own if row["tile"] == own.tile else _Quantised(row, kind)
            n, m, same = len(own.ids), len(other.ids), other is own
            names = own.ids if same else np.concatenate([own.ids, other.ids])
            order = np.argsort(names, kind="stable")
            rank = np.empty(len(names), np.int64)
            rank[order] = np.arange(len(names))
            shift = 0 if same else n
            here, there, labels = np.zeros(n, np.int64), np.zeros(m, np.int64), np.arange(len(names))
            for first, links in tile_links(own, other, threshold):
                if same:
                    span = np.arange(links.shape[0])
                    links[span, span + first] = False
                if not links.any():
                    continue
                here[first : first + len(links)] += links @ other.copies
                if not same:
                    there += own.copies[first : first + len(links)] @ links
                i, j = np.nonzero(links)
                labels = _roots(len(names), rank[i + first], rank[j + shift], labels)
            linked = here if same else np.concatenate([here, there])
            at = np.flatnonzero(linked)
            ids.append(names[at])
            counts.append(linked[at])
            roots.append(names[order[labels[rank[at]]]])
        empty = np.zeros(0, np.int64)
        return pa.table({k: np.concatenate([empty, *v]) for k, v in (("node", ids), ("links", counts), ("root", roots))})

    return compare


def near_vectors(
    df: DataFrame, threshold: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding", tile: int = TILE
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row: links are other rows with cosine >= ``threshold``.

    Equal vectors count once, with the number of their copies. The others are sorted by the
    nearest of some pivots, a sample of at most ``MOST_PIVOTS`` of them, into tiles. Tiles whose
    cones lie further apart than the threshold's angle cannot hold links and are not compared;
    the rest are compared pair by pair. A task returns one row per linked vector, with its number
    of links and the first vector it is joined with there, so groups of copies never become pairs.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
    id, link with nothing: they are their own component. Vectors of different lengths do not link.
    Repeated ids are separate rows. An empty table gives an empty result. Other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    element = df.schema[vector_column].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    rows = working_columns(df, id=id_column, vector=vector_column)
    if kind == "<f8":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.withColumn("id", F.col("id").cast("long"))
    rows = stored(rows.mapInArrow(_keyed(kind), "id LONG, key BINARY, dim INT, vector BINARY"), "vectors")

    unique = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.any_value("dim").alias("dim"),
        F.any_value("vector").alias("vector"),
    )
    unique = numbered(unique, "vector-classes")
    total = unique.count()
    n_pivots = min(MOST_PIVOTS, max(1, total // tile))
    chosen = unique.orderBy(F.xxhash64("key"), "key").limit(n_pivots).select("dim", "vector").collect()
    pivots = {d: _unit([bytes(r.vector) for r in chosen if r.dim == d], kind) for d in {r.dim for r in chosen}}
    celled = unique.select("node", "copies", "dim", "vector").mapInArrow(
        _nearest(kind, pivots), "node LONG, copies LONG, dim INT, vector BINARY, cell LONG"
    )
    celled = stored(celled, "vector-cells")
    sizes = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))
    celled = celled.join(F.broadcast(sizes), ["dim", "cell"])  # a row per pivot and dimension
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    celled = celled.withColumn("tile", F.xxhash64("dim", "cell", chunk))
    tiles = stored(celled.groupBy("tile").applyInArrow(_tile(kind), TILE_SCHEMA), "vector-tiles")

    # which tiles to compare: by their cones, in blocks of tiles
    cones = tiles.select("tile", "dim", "center", "radius")
    n_blocks = max(1, math.ceil(tiles.count() / 1_024))
    cones = cones.withColumn("block", F.pmod(F.col("tile"), F.lit(n_blocks)))
    every = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    asking = cones.withColumn("other", F.explode(every)).withColumnsRenamed({"block": "a", "other": "b"})
    asked = cones.withColumn("other", F.explode(every)).withColumnsRenamed({"block": "b", "other": "a"})
    asked = asked.toDF(*asked.columns)
    near = asking.groupBy("a", "b").cogroup(asked.groupBy("a", "b"))
    work = stored(near.applyInArrow(_close(threshold), "tile LONG, partner LONG"), "vector-pairs")
    parts = work.groupBy("tile").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    work = work.join(parts, "tile").withColumn("part", F.pmod(F.xxhash64("partner"), F.col("parts")))

    data = ["ids", "copies", "vectors"]
    left = work.select("tile", "part").distinct().join(tiles.select("tile", *data), "tile")
    right = work.select(F.col("tile").alias("own"), "part", F.col("partner").alias("tile"))
    right = right.join(tiles.select("tile", *data), "tile")
    left = left.select(F.col("tile").alias("own"), "part", "tile", *data)
    right = right.toDF(*right.columns)  # columns of its own, as both sides come from one table
    pairs = left.groupBy("own", "part").cogroup(right.groupBy("own", "part"))
    found = stored(pairs.applyInArrow(_compare(kind, threshold), "node LONG, links LONG, root LONG"), "vector-links")

    classes = with_components(unique, found, "vector-components")
    result = rows.select("id", "key").join(classes, "key", "left")
    n_links = F.when(F.col("key").isNotNull(), F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    return result.select(
        F.col("id").alias(id_column),
        F.coalesce(n_links, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "rep", "id").alias("component_id"),
    ).withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
