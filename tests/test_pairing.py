"""Greedy day matching against a plain two-pointer walk."""

import random

from pyspark.sql import functions as F

from skyframes.operators import pairing


def walk(base, other, tolerance=120):
    """Base and other as sorted (tod, id); the earliest unused candidate in reach."""
    pairs, at = [], 0
    for tod, b in base:
        while at < len(other) and other[at][0] < tod - tolerance:
            at += 1
        if at < len(other) and other[at][0] <= tod + tolerance:
            pairs.append((b, other[at][1]))
            at += 1
    return pairs


def test_pairs_equal_the_walk_also_in_crowded_seconds(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.randint(1, 4), rng.choice([50, 51, 200, rng.randint(0, 1500)])) for i in range(900)]
    rows += [(1000 + i, "a", 2, 700) for i in range(300)]
    frames = spark.createDataFrame(rows, "frame_id long, device_id string, day long, tod long")
    got = {}
    for r in pairing.day_pairs(frames).collect():
        got.setdefault((r.device_id, r.day, r.neighbour_day), []).append((r.frame_id, r.match_id))
    for device in "ab":
        for day in range(1, 5):
            for neighbour in (day - 1, day + 1):
                lists = [sorted((t, i) for i, d, k, t in rows if (d, k) == (device, n)) for n in (day, neighbour)]
                assert sorted(got.get((device, day, neighbour), [])) == sorted(walk(*lists))


def test_ranks_do_not_depend_on_blocks(spark):
    rows = [(i * 7 % 101, "a", 1, i % 3) for i in range(101)]
    frames = spark.createDataFrame(rows, "frame_id long, device_id string, day long, tod long")
    small = {(r.tod, r["rank"]): r.frame_id for r in pairing.numbered(frames, block=10).collect()}
    for tod in range(3):
        ids = sorted(i for i, _, _, t in rows if t == tod)
        assert [small[(tod, k)] for k in range(len(ids))] == ids


def test_crowded_seconds_are_cut_where_the_ids_are(spark):
    """90 % of the ids lie in 1 % of their range; no block has many more frames than it should."""
    rng = random.Random(6)
    ids = rng.sample(range(10**6, 10**6 + 10**5), 1800) + rng.sample(range(10**7), 200)
    rows = [(i, "a", 1, 5) for i in sorted(set(ids))] + [(-i, "a", 1, 6) for i in range(30)] + [(7, "b", 1, 5)]
    frames = spark.createDataFrame(rows, "frame_id long, device_id string, day long, tod long").repartition(4)
    numbered = pairing.numbered(frames, block=100)
    got = {(r.device_id, r.tod, r["rank"]): r.frame_id for r in numbered.collect()}
    for device, tod in (("a", 5), ("a", 6), ("b", 5)):
        own = sorted(i for i, d, _, t in rows if (d, t) == (device, tod))
        assert [got.pop((device, tod, k)) for k in range(len(own))] == own
    assert not got
    sizes = pairing.blocks(frames, 100)
    assert max(r["size"] for r in sizes.groupBy(*pairing.MOMENT, "block").agg(F.count("*").alias("size")).collect()) <= 200


def test_touching_circles_do_not_overlap(spark):
    df = spark.createDataFrame([(0, 0, 3, 5, 0, 2), (0, 0, 3, 4, 0, 2)], "cx int, cy int, r int, match_cx int, match_cy int, match_r int")
    assert pairing.overlapping(df).count() == 1
