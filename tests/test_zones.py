"""Zones of points against the even-odd rule over every zone."""

import math
import random

from lakemart.operators import zones

_RING = "array<struct<lon double, lat double>>"


def _inside(ring, lon, lat):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _stars(rnd, n):
    out = {}
    for z in range(n):
        lon, lat, size = rnd.uniform(-150, 150), rnd.uniform(-60, 60), rnd.choice([0.05, 2, 25])
        turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.randrange(3, 9)))
        out[f"z{z}"] = [(lon + size * rnd.uniform(.2, 1) * math.cos(t), lat + size * rnd.uniform(.2, 1) * math.sin(t)) for t in turns]
    out["whole"] = [(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0)]
    return out


def test_random_polygons(spark):
    rnd = random.Random(5)
    rings = _stars(rnd, 12)
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)]
    for ring in rings.values():  # near, on and at the corners
        for x, y in ring:
            points += [(len(points), y, x), (len(points) + 1, y + rnd.uniform(-.1, .1), x + rnd.uniform(-.1, .1))]
    points = [(i, max(-90.0, min(90.0, a)), o) for i, a, o in points]
    zs = spark.createDataFrame([*rings.items(), ("null", None), ("line", [(0.0, 0.0), (1.0, 1.0)])], f"zone string, ring {_RING}")
    ps = spark.createDataFrame(points, "id int, lat double, lon double")
    got = sorted((r.id, r.zone) for r in zones.zone_hits(ps, "id", "lat", "lon", zs, (2, 5, 8)).collect())
    want = sorted((i, z) for i, a, o in points for z, ring in rings.items() if _inside(ring, o, a))
    assert got == want
    cells = [(r.zone, r.cell) for r in zones.cover(zs, (2, 5, 8)).select("zone", "cell").collect()]
    assert len(cells) == len(set(cells))


def test_place(spark):
    box = [(10.0, 50.0), (20.0, 50.0), (20.0, 55.0), (10.0, 55.0)]
    zs = spark.createDataFrame([("b", box), ("a", box)], f"zone string, ring {_RING}")
    rows = [(1, 52.0, 15.0), (2, 15.0, 52.0), (3, None, 15.0), (4, 200.0, 15.0), (5, -52.0, 15.0), (6, float("nan"), 1.0), (7, 15.0, 52.0)]
    ps = spark.createDataFrame(rows, "id int, lat double, lon double")
    got = {r.id: (r.status, r.n_zones, r.zone) for r in zones.place_points(ps, "id", "lat", "lon", zs).collect()}
    assert got == {1: ("inside", 2, "a"), 2: ("swapped", 0, "a"), 3: ("missing", 0, None), 4: ("out of range", 0, None),
                   5: ("outside", 0, None), 6: ("missing", 0, None), 7: ("swapped", 0, "a")}
    assert zones.place_points(ps.limit(0), "id", "lat", "lon", zs).count() == 0
    assert [r.status for r in zones.place_points(ps.where("id = 1"), "id", "lat", "lon", zs.limit(0)).collect()] == ["outside"]
