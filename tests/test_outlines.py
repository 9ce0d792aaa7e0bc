from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import plan_of, rows_of
from tidemark.operators.outlines import outline_cells, outline_join

POINTS, OUTLINES = "id int, lon double, lat double", "name string, ring array<struct<x: double, y: double>>"


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def plain(points, outlines):
    out = []
    for i, x, y in points:
        names = [n for n, ring in outlines if None not in (x, y) and len(ring) >= 3 and inside(ring, x, y)]
        out += [(i, x, y, n) for n in names or [None]]
    return sorted(out, key=repr)


def star(x, y, size, corners, seed):
    random.seed(seed)
    ring = []
    for i in range(corners):
        turn, reach = 2 * math.pi * i / corners, size * random.uniform(0.2, 1)
        ring.append((x + reach * math.cos(turn), y + reach * math.sin(turn)))
    return ring


def check(spark, points, outlines, cell):
    found = outline_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(outlines, OUTLINES), cell)
    assert rows_of(found) == plain(points, outlines)
    return found


def test_stars_squares_and_odd_input(spark):
    outlines = [(f"star{i}", star(i - 2, i / 2, 1.5, 9 + i, i)) for i in range(5)]
    outlines += [("square", [(0, 0), (1, 0), (1, 1), (0, 1)]), ("closed", [(1, 0), (2, 0), (2, 1), (1, 1), (1, 0)])]
    outlines += [("line", [(0.0, 0.0), (1.0, 1.0)]), ("none", [])]
    outlines = [(n, [(float(x), float(y)) for x, y in r]) for n, r in outlines]
    random.seed(9)
    points = [(i, random.uniform(-4, 4), random.uniform(-2, 4)) for i in range(2000)]
    # corners, borders and cell edges
    points += [(3000 + i, i / 4, j / 4) for i in range(-2, 10) for j in range(-2, 6)]
    points += [(4000, None, 0.5), (4001, 0.5, None)]
    for cell in (0.25, 0.3, 5.0):
        found = check(spark, points, outlines, cell)
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_neighbours_share_no_point(spark):
    outlines = [(f"{i},{j}", [(i, j), (i + 1.0, j), (i + 1.0, j + 1.0), (i, j + 1.0)]) for i in (0.0, 1.0) for j in (0.0, 1.0)]
    points = [(i * 20 + j, i / 8, j / 8) for i in range(16) for j in range(16)]
    found = check(spark, points, outlines, 0.5)
    assert found.count() == len(points) and found.where("name is null").isEmpty()


def test_cells_inside_need_no_test(spark):
    square = [("s", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])]
    cells = outline_cells(spark.createDataFrame(square, OUTLINES), 1.0).collect()
    assert sum(c["edges"] is None for c in cells) == 64
    assert max(len(c["edges"] or []) for c in cells) <= 4
    # a long slanted edge is in the cells along it, not in all of its extent
    sliver = [("t", [(0.0, 0.0), (100.0, 100.0), (99.0, 100.0)])]
    assert outline_cells(spark.createDataFrame(sliver, OUTLINES), 1.0).count() < 500


def test_clash_and_empty(spark):
    points = spark.createDataFrame([(1, 0.5, 0.5)], POINTS)
    with pytest.raises(ValueError, match="present"):
        outline_join(points.withColumnRenamed("id", "name"), spark.createDataFrame([], OUTLINES), 1.0)
    assert rows_of(outline_join(points, spark.createDataFrame([], OUTLINES), 1.0)) == [(1, 0.5, 0.5, None)]


GRID = st.integers(-8, 8).map(lambda n: n / 4)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.lists(st.tuples(GRID, GRID), min_size=3, max_size=8, unique=True), min_size=1, max_size=3),
    st.lists(st.tuples(GRID, GRID), min_size=1, max_size=30),
    st.sampled_from([0.25, 0.37, 1.0]),
)
def test_any_outlines(spark, rings, at, cell):
    """Corners and points on one grid, so borders and corners are met often; rings may cross themselves."""
    check(spark, [(i, x, y) for i, (x, y) in enumerate(at)], [(f"r{i}", r) for i, r in enumerate(rings)], cell)
