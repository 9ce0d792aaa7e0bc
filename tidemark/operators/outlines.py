"""Assigning points to regions given by their outlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells are widened by this share of their size when edges are sought, so rounding cannot hide one.
_SLACK = 1e-6


def crossings(edges: Column, x: Column, y: Column) -> Column:
    """How many edges (structs x1, y1, x2, y2) a ray from the point to larger x meets.

    An edge counts for y in ``[low, high)`` of its ends, so a ray through a corner
    counts it once, and of two regions with a common border each point is in one.
    """

    def met(e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)

    return F.size(F.filter(edges, met))


def outline_cells(outlines: DataFrame, cell: float, ring: str = "ring") -> DataFrame:
    """One row per outline and grid cell that it touches or covers: ``cx``, ``cy`` and ``edges``.

    ``edges`` is NULL for a cell wholly inside. For a cell that the outline runs
    through it has the edges that a ray from a point of the cell can meet, which are those of the
    cell's row that do not end before the cell.
    """
    names = [c for c in outlines.columns if c != ring]
    corners = F.col(ring)
    follows = F.concat(F.slice(corners, 2, F.size(corners)), F.slice(corners, 1, 1))
    edges = F.transform(
        F.arrays_zip(corners.alias("a"), follows.alias("b")),
        lambda p: F.struct(
            p["a"]["x"].cast("double").alias("x1"),
            p["a"]["y"].cast("double").alias("y1"),
            p["b"]["x"].cast("double").alias("x2"),
            p["b"]["y"].cast("double").alias("y2"),
        ),
    )
    rows = outlines.where(F.size(ring) >= 3).withColumn("__edges", edges)

    def reach(of, by: str) -> Column:
        return F.floor(of(F.transform(ring, lambda p: p[by].cast("double"))) / F.lit(cell)).cast("long")

    rows = rows.withColumn("cy", F.explode(F.sequence(reach(F.array_min, "y"), reach(F.array_max, "y"))))
    low, high = (F.col("cy") - _SLACK) * cell, (F.col("cy") + 1 + _SLACK) * cell
    in_row = F.filter("__edges", lambda e: (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["y1"], e["y2"]) >= low))
    rows = rows.withColumn("__row", in_row)
    rows = rows.withColumn("cx", F.explode(F.sequence(reach(F.array_min, "x"), reach(F.array_max, "x"))))
    left, right = (F.col("cx") - _SLACK) * cell, (F.col("cx") + 1 + _SLACK) * cell

    def touches(e: Column) -> Column:
        """Whether the edge meets the cell: their extents do, and the corners are not all on one side of its line."""

        def side(px: Column, py: Column) -> Column:
            return F.signum((e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"]))

        sides = [side(px, py) for px in (left, right) for py in (low, high)]
        one_side = F.abs(sides[0] + sides[1] + sides[2] + sides[3]) == 4
        return (F.least(e["x1"], e["x2"]) <= right) & (F.greatest(e["x1"], e["x2"]) >= left) & ~one_side

    through = F.exists("__row", touches)
    centre = crossings(F.col("__row"), (F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell) % 2 == 1
    near = F.filter("__row", lambda e: F.greatest(e["x1"], e["x2"]) >= left)
    rows = rows.withColumn("__through", through).where(F.col("__through") | centre)
    return rows.select(*names, "cx", "cy", F.when(F.col("__through"), near).alias("edges"))


def outline_join(
    points: DataFrame,
    outlines: DataFrame,
    cell: float,
    x: str = "lon",
    y: str = "lat",
    ring: str = "ring",
    how: str = "left",
) -> DataFrame:
    """Points with the columns of every outline they lie in (but ``ring``).

    ``ring`` is an array of corners (structs ``x``, ``y``) of one simple polygon, open or
    closed. Outlines are listed by grid cell, so points meet them by an equi-join
    on the cell. In a cell wholly inside nothing more is tested; in one on the border the
    exact crossing test runs over the few edges near it. NULL coordinates lie nowhere, and outlines
    of fewer than three corners hold nothing. Choose ``cell`` some times smaller than an outline.
    """
    clash = sorted(set(points.columns) & (set(outlines.columns) - {ring}))
    if clash:
        raise ValueError(f"columns already present: {clash}")
    names = [c for c in outlines.columns if c != ring]
    cells = outline_cells(outlines, cell, ring).withColumnsRenamed({"cx": "__cx", "cy": "__cy", "edges": "__near"})
    placed = points.withColumn("__px", F.floor(F.col(x) / F.lit(cell)).cast("long"))
    placed = placed.withColumn("__py", F.floor(F.col(y) / F.lit(cell)).cast("long"))
    inside = F.col("__near").isNull() | (crossings(F.col("__near"), F.col(x), F.col(y)) % 2 == 1)
    on = (F.col("__px") == F.col("__cx")) & (F.col("__py") == F.col("__cy")) & inside
    return placed.join(cells, on, how).select(*points.columns, *names)
