"""Exact bounds on cosines that leave products out: a rotation that gathers length in the first dimensions, and cells of near vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that the rotation and the cells are chosen from, and most cells. Any choice gives the same pairs.
SAMPLE_ROWS, MOST_CELLS = 2000, 128
#: Least share of length in the first dimensions for which they are compared first, and most of all dimensions that these may be.
GATHERED, MOST_FIRST = 0.9, 0.5
#: Allowance for rounding, in cosines and in radians.
SLACK, ANGLE_SLACK = 1e-9, 1e-7


@dataclass
class Geometry:
    """For vectors of one length: the first columns of an orthogonal matrix (or None), and directions that cells stand around."""

    first: np.ndarray | None
    pivots: np.ndarray


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def geometry(sample: np.ndarray) -> Geometry:
    """Chosen from some vectors: the directions of most variance, and vectors far apart (each next one farthest from those before)."""
    u = unit(sample)
    values, vectors = np.linalg.eigh(u.T @ u)
    share = np.cumsum(values[::-1]) / values.sum()
    k = int(np.searchsorted(share, GATHERED)) + 1
    first = np.ascontiguousarray(vectors[:, ::-1][:, :k]) if k <= MOST_FIRST * u.shape[1] else None
    chosen, nearest = [0], u @ u[0]
    while len(chosen) < min(MOST_CELLS, len(u)) and nearest.min() < 0.9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, u @ u[chosen[-1]])
    return Geometry(first, u[chosen])


def candidates(g: Geometry | None, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray | None:
    """Which pairs of two sets of unit vectors may reach the threshold: the product of the first dimensions and the product of what
    is left of the lengths bound a cosine from above (Cauchy-Schwarz). None where that needs no product less."""
    if g is None or g.first is None:
        return None
    x, y = a @ g.first, b @ g.first
    rest = [np.sqrt(np.maximum(0, 1 - (z * z).sum(axis=1))) for z in (x, y)]
    return x @ y.T + rest[0][:, None] * rest[1][None, :] >= threshold - SLACK


def cells_of(rows: DataFrame, known: dict[int, Geometry]) -> DataFrame:
    """``rows`` (.., d, v) with ``cell``, the nearest pivot, and ``angle`` to it."""

    def place(batches):
        for b in batches:
            cell, angle = np.zeros(len(b), np.int32), np.full(len(b), np.pi)
            for d, at in b.groupby("d").indices.items():
                if d in known:
                    s = unit(np.array(b["v"].iloc[at].tolist(), float)) @ known[d].pivots.T
                    cell[at] = s.argmax(axis=1)
                    angle[at] = np.arccos(np.clip(s.max(axis=1), -1, 1))
            yield b.assign(cell=cell, angle=angle)

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(place, f"{kind}, cell int, angle double")


def near_cells(placed: DataFrame, known: dict[int, Geometry], threshold: float, block_rows: int) -> DataFrame:
    """(g, d, cell, part, blocks, other, others): the pairs of cells of a group that can hold a pair at the threshold, both ways, and each
    cell itself. Vectors of two cells are at least as far apart as the pivots less the angles of the farthest vectors around them.

    ``part`` is the cell, or -1 for all cells of a group whose vectors would be copied more often by cells than without. A group has
    MOST_CELLS cells at most, so its pairs of cells are bounded."""
    sizes = placed.groupBy("g", "d", "cell").agg(F.max("angle").alias("angle"), F.count("*").alias("n"))
    limit = float(np.arccos(min(1.0, threshold))) + ANGLE_SLACK

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        d = int(rows["d"].iloc[0])
        cell, angle, n = rows["cell"].to_numpy(), rows["angle"].to_numpy(), rows["n"].to_numpy()
        blocks, whole = -(-n // block_rows), -(-n.sum() // block_rows)
        if d in known:
            p = known[d].pivots[cell]
            near = np.arccos(np.clip(p @ p.T, -1, 1)) - angle[:, None] - angle[None, :] <= limit
            near |= np.eye(len(rows), dtype=bool)
        if d not in known or (n * (near * blocks).sum(axis=1)).sum() >= n.sum() * whole:
            return pd.DataFrame({"g": rows["g"].iloc[0], "d": d, "cell": cell, "part": -1, "other": -1, "blocks": whole, "others": whole})
        i, j = np.nonzero(near)
        return pd.DataFrame({"g": rows["g"].iloc[0], "d": d, "cell": cell[i], "part": cell[i], "other": cell[j], "blocks": blocks[i], "others": blocks[j]})

    return sizes.groupBy("g", "d").applyInPandas(pairs, "g string, d int, cell int, part int, other int, blocks int, others int")


def sample_of(rows: DataFrame, big: DataFrame) -> dict[int, Geometry]:
    """The geometry of each vector length that occurs in groups of several blocks, from its SAMPLE_ROWS rows of least hash."""
    line = Window.partitionBy("d").orderBy(F.xxhash64("pos", "id"))
    some = rows.join(F.broadcast(big.select("g", "d")), ["g", "d"], "left_semi").withColumn("r", F.row_number().over(line)).filter(F.col("r") <= SAMPLE_ROWS)
    by: dict[int, list] = {}
    for r in some.select("d", "v").collect():
        by.setdefault(r["d"], []).append(r["v"])
    return {d: geometry(np.array(v, float)) for d, v in by.items()}
