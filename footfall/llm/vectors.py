"""Near-duplicate vectors: PCA-ordered tiles, compared dimension by dimension.

Vectors are turned into the axes of largest spread. A tile of products then grows
from the leading dimensions on; what the others can still add is bounded by the
product of the suffix norms, and pairs whose bound is below the threshold are left.
The axes only order the work: every link is decided by the cosine of the original
vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stage
from footfall.llm.components import components

THRESHOLD = 0.93
#: Vectors that the axes are fitted on at most, chosen by a hash of the id.
AXES_SAMPLE = 2_048
#: Vectors of a tile, about.
TILE = 1_024
_STEP = 8  # dimensions added at a time
_SLACK = 1e-9


def fit_axes(vectors: DataFrame, most: int = AXES_SAMPLE) -> dict[int, np.ndarray]:
    """Orthogonal axes by number of dimensions, largest spread first."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("raw").collect()
    by_size: dict[int, list[np.ndarray]] = {}
    for row in sample:  # at most ``most`` vectors
        v = np.frombuffer(row.raw, "<f8")
        by_size.setdefault(len(v), []).append(v / np.linalg.norm(v))
    axes = {}
    for size, rows in by_size.items():
        values, columns = np.linalg.eigh(np.stack(rows).T @ np.stack(rows))
        axes[size] = columns[:, np.argsort(-values)]
    return axes


def scaled(values: list[float | None] | None) -> np.ndarray | None:
    """A vector times the power of two that brings its largest component to 1/2 or more, below 1.

    Cosines do not change and squares neither vanish nor overflow, at any magnitude of
    the components. None where a vector links with nothing.
    """
    if values is None or None in values:
        return None
    v = np.array(values, "<f8")
    if not len(v) or not np.isfinite(v).all() or not v.any():
        return None
    return np.ldexp(v, -np.frexp(np.abs(v).max())[1]).astype("<f8")


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scaled vectors as bytes of doubles; null where a vector links with nothing."""
    for batch in batches:
        raw = []
        for values in batch.column("embedding").to_pylist():
            v = scaled(values)
            raw.append(None if v is None else v.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(raw, pa.binary())],
            ["vec_id", "label", "raw"],
        )


def near_vectors(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Vectors are compared when their labels are equal and not null and they have as
    many dimensions. Equal vectors are compared once and counted as often as they
    occur. Vectors that are close have close leading coordinates, so they are put
    into cells as wide as the largest distance at the threshold and only tiles of
    neighbouring cells meet; a full cell is dealt over several tiles. A pair of
    tiles returns numbers of links and a spanning forest of its links, never the
    links themselves.

    * null, empty or zero vector, null or non-finite components, null label or id:
      links with nothing; component_id is its own id.
    * repeated ids: one node; each row counts as a vector.
    * empty table: no rows. Other columns are ignored, whatever their names.
    """
    given = embeddings.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
        F.col(vector_col).alias("embedding"),
    )
    kinds = dict(given.dtypes)
    rows = stage(
        given.mapInArrow(_usable, f"vec_id {kinds['vec_id']}, label {kinds['label']}, raw binary"),
        "vectors",
    )
    live = rows.filter("raw IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    distinct = stage(
        live.groupBy("label", "raw").agg(
            F.min("vec_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("copies")
        ),
        "distinct_vectors",
    )
    axes = fit_axes(distinct.select(F.col("rep").alias("vec_id"), "raw"))
    found = stage(_compare(distinct, axes, threshold, tile), "tile_results")
    links = found.filter("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    forest = found.filter("other IS NOT NULL").select(
        F.col("node").alias("a"), F.col("other").alias("b")
    )
    named = stage(
        distinct.join(links, F.col("rep") == F.col("node"), "left")
        .join(components(forest), F.col("rep") == F.col("id"), "left")
        .select(
            F.col("label").alias("l"),
            F.col("raw").alias("r"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        ),
        "vector_classes",
    )
    same = (F.col("label") == F.col("l")) & (F.col("raw") == F.col("r")) & F.col("vec_id").isNotNull()
    component = F.coalesce("component", "vec_id")
    return rows.join(named, same, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _compare(distinct: DataFrame, axes, threshold: float, tile: int) -> DataFrame:
    width = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, c0, c1 = [], [], []
            for raw in batch.column("raw").to_pylist():
                v = np.frombuffer(raw, "<f8")
                unit = v / np.linalg.norm(v)
                turn = axes.get(len(v))
                lead = unit @ turn[:, :2] if turn is not None else unit[:2]
                dims.append(len(v))
                c0.append(math.floor(lead[0] / width))
                c1.append(math.floor(lead[1] / width) if len(lead) > 1 else 0)
            more = [pa.array(x, pa.int32()) for x in (dims, c0, c1)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("label", "rep", "copies", "raw")], *more],
                ["label", "rep", "copies", "raw", "dims", "c0", "c1"],
            )

    kind = dict(distinct.dtypes)["label"]
    key = ["label", "dims", "c0", "c1"]
    placed = stage(
        distinct.select("label", "rep", "copies", "raw").mapInArrow(
            cells, f"label {kind}, rep long, copies long, raw binary, dims int, c0 int, c1 int"
        ),
        "cells",
    )
    full = stage(
        placed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles")), "cell_sizes"
    )
    dealt = placed.join(full, key).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("tiles")))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep")
        first = frame.iloc[0]
        return pd.DataFrame(
            {
                **{k: [first[k]] for k in [*key, "part"]},
                "reps": [frame["rep"].to_numpy("<i8").tobytes()],
                "copies": [frame["copies"].to_numpy("<i8").tobytes()],
                "data": [b"".join(frame["raw"])],
            }
        )

    tiles = stage(
        dealt.groupBy(*key, "part").applyInPandas(
            pack,
            f"label {kind}, dims int, c0 int, c1 int, part long, reps binary, copies binary, data binary",
        ).withColumn("tile", F.xxhash64(*key, "part")),
        "tiles",
    )
    head = tiles.select(*key, "part", "tile")
    # each pair of cells once: the second coordinate looks both ways only if the first differs
    steps = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("d0"), F.lit(b).alias("d1")) for a, b in steps]))
    left = head.select(
        "label", "dims", "c0", "c1", "part", F.col("tile").alias("tile_a"), around.alias("d")
    ).select(
        "label", "dims", (F.col("c0") + F.col("d.d0")).alias("c0"),
        (F.col("c1") + F.col("d.d1")).alias("c1"), F.col("part").alias("part_a"), "tile_a",
        ((F.col("d.d0") == 0) & (F.col("d.d1") == 0)).alias("home"),
    )
    right = head.withColumnRenamed("tile", "tile_b")
    pairs = left.join(right, key).filter("NOT home OR part_a <= part").select("tile_a", "tile_b")
    body = tiles.select("tile", "dims", "reps", "copies", "data")
    named_a = body.select(*[F.col(c).alias(f"{c}_a") for c in body.columns])
    named_b = body.select(*[F.col(c).alias(f"{c}_b") for c in body.columns])
    meetings = stage(pairs, "tile_pairs").join(named_a, "tile_a").join(named_b, "tile_b")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                turn = axes.get(row.dims_a)
                a = _Tile(row.reps_a, row.copies_a, row.data_a, row.dims_a, turn)
                same = row.tile_a == row.tile_b
                b = a if same else _Tile(row.reps_b, row.copies_b, row.data_b, row.dims_b, turn)
                yield tile_links(a, b, same, threshold)

    return meetings.select(
        "tile_a", "tile_b", "dims_a", "dims_b", "reps_a", "reps_b", "copies_a", "copies_b",
        "data_a", "data_b",
    ).mapInPandas(compare, "node long, other long, links long")


class _Tile:
    def __init__(self, reps: bytes, copies: bytes, data: bytes, dims: int, turn):
        self.reps = np.frombuffer(reps, "<i8")
        self.copies = np.frombuffer(copies, "<i8")
        self.rows = np.frombuffer(data, "<f8").reshape(-1, dims)
        self.norms = np.linalg.norm(self.rows, axis=1)
        unit = self.rows / self.norms[:, None]
        self.turned = unit if turn is None else unit @ turn
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]
        self.suffix = np.sqrt(np.concatenate([squares, np.zeros((len(squares), 1))], axis=1))


def close_pairs(a: _Tile, b: _Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) whose cosine reaches the threshold."""
    dims, least = a.turned.shape[1], threshold - _SLACK
    upto = min(_STEP, dims)
    sums = a.turned[:, :upto] @ b.turned[:, :upto].T
    i, j = np.nonzero(sums + np.outer(a.suffix[:, upto], b.suffix[:, upto]) >= least)
    some = sums[i, j]
    while upto < dims and len(i):
        to = min(upto + _STEP, dims)
        keep, fresh = [], []
        for at in range(0, len(i), 1 << 16):  # bounded memory
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            grown = some[at : at + (1 << 16)] + np.einsum(
                "ij,ij->i", a.turned[x, upto:to], b.turned[y, upto:to]
            )
            left = grown + a.suffix[x, to] * b.suffix[y, to] >= least
            keep.append(np.flatnonzero(left) + at)
            fresh.append(grown[left])
        kept = np.concatenate(keep)
        i, j, some, upto = i[kept], j[kept], np.concatenate(fresh), to
    good = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        dot = np.einsum("ij,ij->i", a.rows[x], b.rows[y])
        good[at : at + (1 << 16)] = dot / (a.norms[x] * b.norms[y]) >= threshold
    return i[good], j[good]


def tile_links(a: _Tile, b: _Tile, same: bool, threshold: float) -> pd.DataFrame:
    """Numbers of links per vector, and a spanning forest of the links."""
    i, j = close_pairs(a, b, threshold)
    if same:
        i, j = i[i != j], j[i != j]
    reps = a.reps if same else np.concatenate([a.reps, b.reps])
    n = len(a.reps)
    count = np.zeros(len(reps), np.int64)
    np.add.at(count, i, b.copies[j])
    if not same:
        np.add.at(count, n + j, a.copies[i])
        j = n + j
    root = np.arange(len(reps))
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    linked, hung = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(reps)))
    return pd.DataFrame(
        {
            "node": np.concatenate([reps[linked], reps[hung]]),
            "other": pd.array([None] * len(linked) + reps[root[hung]].tolist(), "Int64"),
            "links": np.concatenate([count[linked], np.zeros(len(hung), np.int64)]),
        }
    )
