"""Colour, name, circle and track expressions on hand-made rows."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframes.functions import color, names
from skyframes.operators import kernels, sun, track


def test_color_rule_at_its_limits(spark):
    cases = {
        (121, 101, 80): True, (120, 101, 80): False, (121, 100, 79): False, (101, 101, 101): True, (100, 101, 101): False,
        (101, 99, 78): True, (101, 99, 79): False, (100, 99, 78): False, (99, 78, 57): True, (99, 79, 57): False, (0, 0, 0): False,
    }
    df = spark.createDataFrame([(*bgr, want) for bgr, want in cases.items()], "b int, g int, r int, want boolean")
    wrong = df.where(color.is_sky_color(F.col("b"), F.col("g"), F.col("r")) != F.col("want")).collect()
    assert wrong == []


def test_sun_hue_shortcut_equals_hue(spark):
    steps = F.explode(F.expr("sequence(0, 255, 15)"))
    df = spark.range(1).select(steps.alias("b")).select("b", steps.alias("g")).select("b", "g", steps.alias("r"))
    df = df.unionByName(df.selectExpr("greatest(b - 1, 0) as b", "g", "least(r + 3, 255) as r"))
    bgr = [F.col(c) for c in "bgr"]
    assert df.where(color.is_sun_hue(*bgr) != (color.hue(*bgr) <= 10)).count() == 0


def test_names_round_trip_and_odd_names(spark):
    df = spark.createDataFrame([("04E670000001", 1441101630)], "d string, ts long")
    row = df.select(names.frame_name(F.col("d"), F.col("ts")).alias("n"), names.folder_name(F.col("d"), F.col("ts"), F.col("ts") + 60).alias("f")).first()
    assert row.n == "04E670000001_09-01-2015_10-00-30.jpg"
    assert row.f == "04E67000000109-01_10-00_to_09-01_10-01"
    odd = spark.createDataFrame([(row.n,), ("holiday.jpg",), ("",)], "n string").select(names.time_of_day(F.col("n"))).collect()
    assert [r[0] for r in odd] == [36030, None, None]


def smallest_circle(points):
    """By trying all pairs and triples."""
    best = None
    circles = [(x, y, 0.0) for x, y in points]
    circles += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2, math.dist(a, b) / 2) for a, b in itertools.combinations(points, 2)]
    for a, b, c in itertools.combinations(points, 3):
        m = 2 * np.array([[b[0] - a[0], b[1] - a[1]], [c[0] - a[0], c[1] - a[1]]], float)
        if abs(np.linalg.det(m)) > 1e-9:
            rhs = np.array([b[0] ** 2 + b[1] ** 2 - a[0] ** 2 - a[1] ** 2, c[0] ** 2 + c[1] ** 2 - a[0] ** 2 - a[1] ** 2])
            o = np.linalg.solve(m, rhs)
            circles.append((*o, math.dist(o, a)))
    for x, y, r in circles:
        if all(math.dist((x, y), p) <= r + 1e-7 for p in points) and (best is None or r < best[2]):
            best = (x, y, r)
    return best


def test_enclosing_circle_is_the_smallest(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for k in range(60):
        n = int(rng.integers(1, 12))
        pos = sorted({int(p) for p in rng.integers(0, 20 * 20, n)}) if k % 5 else [k + 21 * i for i in range(n)]
        rows.append((k, 20, 20, pos))
        want[k] = smallest_circle([(p % 20, p // 20) for p in pos])
    df = spark.createDataFrame(rows, "k int, height int, width int, pos array<int>")
    for row in sun.enclosing_circles(df).collect():
        x, y, r = (math.floor(round(v, 6)) for v in want[row.k])
        assert (row.cx, row.cy, row.r) == (x, y, r), row.k


def test_disc_is_clipped(spark):
    for cx, cy, r in ((0, 1, 3), (4, 5, 2), (30, 30, 2)):
        want = [(y, x) for y in range(10) for x in range(8) if (x - cx) ** 2 + (y - cy) ** 2 <= r**2]
        assert list(zip(*np.nonzero(kernels.disc(cx, cy, r, 10, 8)))) == want
        assert list(zip(*np.nonzero(kernels.disc(cx, cy, r, 6, 5, 4, 3)))) == [(y - 4, x - 3) for y, x in want if y >= 4 and x >= 3]
        assert sun.disc_area(cx, cy, r, np.ones((10, 8), bool)) == len(want)


def test_planted_parabola_is_found(spark):
    theta, height = math.radians(30), 640
    rows = []
    for u in range(-200, 201, 20):
        v = 0.002 * u * u + 0.1 * u + 40
        x, y = u * math.cos(theta) + v * math.sin(theta) + 300, -u * math.sin(theta) + v * math.cos(theta) + 300
        rows.append(("d", 1, round(x), height - round(y)))
    rows += [("few", 1, 1, 1), ("few", 1, 5, 9), ("few", 1, 9, 3), *[("same", 1, 7 + i % 2, 8) for i in range(9)]]
    fits = track.fit_tracks(spark.createDataFrame(rows, "device_id string, day long, cx int, cy int")).collect()
    assert [f.device_id for f in fits] == ["d"]
    fit = fits[0]
    assert abs(fit.theta - theta) < 0.03 and abs(fit.a2 - 0.002) < 1e-4
    x, y = np.array([(r[2], height - r[3]) for r in rows if r[0] == "d"], float).T
    u, v = x * math.cos(fit.theta) - y * math.sin(fit.theta), x * math.sin(fit.theta) + y * math.cos(fit.theta)
    coeffs, rss, *_ = np.polyfit(u, v, 2, full=True)
    assert rss[0] == pytest.approx(fit.rss, rel=1e-4) and coeffs == pytest.approx([fit.a2, fit.a1, fit.a0], rel=1e-4)
    points = track.track_points(track.fit_tracks(spark.createDataFrame(rows, "device_id string, day long, cx int, cy int"))).collect()
    assert points and min(math.dist((p.x, p.y), (x[10], y[10])) for p in points) < 3
