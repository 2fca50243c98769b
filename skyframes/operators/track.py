"""Sun track: the rotated parabola through the agreed sun centres of a device and day."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframes.functions.once import with_once

TRACK = ("device_id", "day")
MOMENTS = [(i, j) for i in range(5) for j in range(5 - i)]


def centroids(sun_pairs: DataFrame) -> DataFrame:
    """Both centres of every pair, duplicates kept, under the pair's device and day."""
    both = F.explode(F.array(F.struct("cx", "cy"), F.struct(F.col("match_cx").alias("cx"), F.col("match_cy").alias("cy"))))
    return sun_pairs.select(*TRACK, both.alias("c")).select(*TRACK, "c.cx", "c.cy")


def flip_rotate(points: DataFrame, theta: Column, height: int = 640) -> DataFrame:
    """Centres with y upwards, turned by `theta`: adds u and v."""
    x, y = F.col("cx"), F.lit(height) - F.col("cy")
    return points.withColumns({"u": x * F.cos(theta) - y * F.sin(theta), "v": x * F.sin(theta) + y * F.cos(theta)})


def _central(i: int, j: int) -> str:
    """Moment around the mean, from the moments around the frame centre."""
    terms = [
        f"{math.comb(i, p) * math.comb(j, q)} * m{p}{q} * pow(-mx, {i - p}) * pow(-my, {j - q})"
        for p in range(i + 1)
        for q in range(j + 1)
    ]
    return " + ".join(terms)


def _turned(k: int) -> str:
    """Sum of the k-th powers of u after turning. Rotation mixes moments, so no point is looked at again."""
    return " + ".join(f"{math.comb(k, j)} * c{k - j}{j} * pow(k.c, {k - j}) * pow(-k.s, {j})" for j in range(k + 1))


def _best(angles: str) -> Column:
    """Least-squares parabola with the least rounded rss over an array of angles, ties by angle.

    Normal equations in central moments; angles at which the points give no parabola are
    left out, and the result is null if none is left.
    """
    steps = f"transform({angles}, t -> named_struct('theta', t, 'c', cos(t), 's', sin(t)))"
    sums = f"""transform({steps}, k -> named_struct(
        'theta', k.theta, 's2', {_turned(2)}, 's3', {_turned(3)}, 's4', {_turned(4)},
        'uv', k.c * k.s * (c20 - c02) + (k.c * k.c - k.s * k.s) * c11,
        'vv', k.s * k.s * c20 + 2 * k.s * k.c * c11 + k.c * k.c * c02,
        'uuv', k.c * k.c * k.s * c30 + (pow(k.c, 3) - 2 * k.c * k.s * k.s) * c21
             + (pow(k.s, 3) - 2 * k.c * k.c * k.s) * c12 + k.s * k.s * k.c * c03))"""
    systems = f"""transform({sums}, f -> named_struct('f', f, 'bend', f.s4 - f.s2 * f.s2 / n))"""
    solved = f"""transform(
        transform({systems}, e -> named_struct('f', e.f, 'bend', e.bend, 'det', e.bend * e.f.s2 - e.f.s3 * e.f.s3)),
        e -> named_struct('f', e.f, 'proper', e.det > 1e-9 * e.f.s4 * e.f.s2,
          'a2', try_divide(e.f.uuv * e.f.s2 - e.f.s3 * e.f.uv, e.det),
          'a1', try_divide(e.bend * e.f.uv - e.f.s3 * e.f.uuv, e.det)))"""
    fits = f"""transform(filter({solved}, e -> e.proper), e -> named_struct(
        'rss', round(e.f.vv - e.a2 * e.f.uuv - e.a1 * e.f.uv, 6), 'theta', e.f.theta,
        'a2', e.a2, 'a1', e.a1, 's2', e.f.s2))"""
    return F.expr(f"array_min({fits})")


def fit_tracks(points: DataFrame, width: int = 640, height: int = 640) -> DataFrame:
    """Tracks (device_id, day, theta, a2, a1, a0, rss, n): v = a2 u^2 + a1 u + a0 after turning by theta.

    Points are counted by place, and an aggregate gathers the 15 power sums of a device and day as exact integers; centring,
    the search over theta (one degree over half a turn, then a hundredth around the best) and
    the solution are arithmetic on that row. Up to 3 points, or points at fewer than three
    places, give no row.
    """
    centred = points.selectExpr(*TRACK, f"bigint(cx - {width // 2}) as x", f"bigint({height - height // 2} - cy) as y")

    def power(name: str, k: int) -> str:
        return " * ".join([name] * k) or "1"

    placed = centred.groupBy(*TRACK, "x", "y").agg(F.count(F.lit(1)).alias("w"))
    moments = [F.expr(f"sum(w * {power('x', i)} * {power('y', j)})").alias(f"m{i}{j}") for i, j in MOMENTS]
    # points at two places have no determinant but the rounding of their moments
    sums = placed.groupBy(*TRACK).agg(*moments, F.count(F.lit(1)).alias("places")).where("places > 2").drop("places")
    means = sums.where("m00 > 3").selectExpr("*", "double(m00) as n", "m10 / m00 as mx", "m01 / m00 as my")
    rows = with_once(means, **{f"c{i}{j}": F.expr(_central(i, j)) for i, j in MOMENTS if 2 <= i + j})
    coarse = _best("transform(sequence(0, 179), k -> k * pi() / 180)")
    found = with_once(rows, coarse=coarse).where("coarse is not null")
    fine = _best(
        "transform(sequence(int(round(coarse.theta * 18000 / pi())) - 100, int(round(coarse.theta * 18000 / pi())) + 100),"
        " k -> k * pi() / 18000)"
    )
    best = with_once(found, best=fine).where("best is not null")
    cos, sin = F.cos("best.theta"), F.sin("best.theta")
    mean_x, mean_y = F.col("mx") + width // 2, F.col("my") + height // 2
    placed = best.select(
        *TRACK, F.col("best.theta").alias("theta"), F.col("best.a2").alias("b2"), F.col("best.a1").alias("b1"),
        (-F.col("best.s2") * F.col("best.a2") / F.col("n")).alias("b0"), F.col("best.rss").alias("rss"), F.col("m00").alias("n"),
        (cos * mean_x - sin * mean_y).alias("u"), (sin * mean_x + cos * mean_y).alias("v"),
    )
    return placed.select(
        *TRACK, "theta", F.col("b2").alias("a2"), F.expr("b1 - 2 * b2 * u").alias("a1"),
        F.expr("b0 - b1 * u + b2 * u * u + v").alias("a0"), "rss", "n",
    )


def track_points(tracks: DataFrame, width: int = 640, height: int = 640, reach: int = 10000, step: float = 0.5) -> DataFrame:
    """Points of each track inside the frame, y upwards: (device_id, day, i, x, y)."""
    i = F.explode(F.sequence(F.lit(0), F.lit(int(2 * reach / step) - 1)))
    curve = (
        tracks.select(*TRACK, "a2", "a1", "a0", F.cos("theta").alias("c"), F.sin("theta").alias("s"), i.alias("i"))
        .withColumn("u", F.col("i") * step - reach)
        .withColumn("v", F.expr("a2 * u * u + a1 * u + a0"))
        .select(*TRACK, "i", F.expr("c * u + s * v").alias("x"), F.expr("c * v - s * u").alias("y"))
    )
    return curve.where(F.col("x").between(0, width) & F.col("y").between(0, height))
