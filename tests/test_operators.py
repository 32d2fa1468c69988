import math
import random
import statistics
import struct

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from listing_lake.functions.geo import EARTH_RADIUS_M
from listing_lake.functions import geo
from listing_lake.operators import dedupe, increments, merge, quality, spatial
from listing_lake.operators import lookup as L
from listing_lake.operators import quantiles as Q
from listing_lake.operators.state import captcha_prefix, fold_states
from listing_lake.plans import scoring
from listing_lake.plans.reference import price_per_m2


def gap(a, b):
    la, lo, lb, ob = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - lo) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


# ---------------------------------------------------------------- medians

def test_order_statistics_match_brute_force(spark):
    rnd = random.Random(1)
    data = [(g, v) for g in ("a", "b", None) for v in [rnd.choice([0.0, -0.0, -5.5, rnd.uniform(-1e6, 1e6), 7.25]) for _ in range(101)]]
    data += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None), ("hot", 1.0)] + [("hot", 4.0)] * 500
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in Q.quantiles(df, ["g"], "v", {"q1": 0.25, "q2": 0.5}, lower_middle="low").collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        values.sort()
        assert got[g]["low"] == values[(len(values) - 1) // 2]
        assert got[g]["q2"] == pytest.approx(statistics.median(values))
        at = (len(values) - 1) * 0.25
        lo = values[math.floor(at)]
        assert got[g]["q1"] == pytest.approx(lo + (values[math.ceil(at)] - lo) * (at - math.floor(at)))


def test_weighted_median(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 1), (3.0, 4)], "v double, w long")
    assert Q.lower_median(df, [], "v", "m", weight="w").first()["m"] == 1.0
    assert Q.median(df, [], "v", "m", weight="w").first()["m"] == 1.5


def test_fence_is_inclusive_and_missing_is_invalid(spark):
    df = spark.createDataFrame([(x, 1.0) for x in (10.0, 20.0, 30.0, 40.0, 1000.0)] + [(5.0, 0.0), (None, 1.0)], "costo_total_clp double, superficie_util_m2 double")
    flags = {r["costo_total_clp"]: (r["precio_m2"], r["precio_m2_valido"]) for r in price_per_m2(df).collect()}
    assert flags[40.0] == (40.0, True) and flags[1000.0] == (1000.0, False)
    assert flags[5.0] == (None, False) and flags[None] == (None, False)


def test_empty_input_gives_no_fence(spark):
    df = spark.createDataFrame([], "v double")
    assert [tuple(r) for r in Q.iqr_fence(df, "v").collect()] == [(None, None)]


# ---------------------------------------------------------------- lookups

@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_splitting_heavy_keys_changes_nothing(spark, how):
    left = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 7}") for i in range(3000)], "i long, k string"
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4), ("other", 5)], "k string, v int")
    assert L.heavy_keys(left.filter("k is not null").select("k"), ["k"], min_rows=100).count() > 0
    assert rows(L.skew_join(left, right, ["k"], how, min_rows=100)) == rows(left.join(right, "k", how))


def test_a_split_of_a_hot_key_keeps_to_the_row_budget(spark):
    left = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    split, _ = L.split_heavy(left, left.select("k").distinct(), ["k"], min_rows=1000)
    assert split.groupBy("k", "__salt").count().agg(F.max("count")).first()[0] < 1300
    assert [r["__parts"] for r in L.heavy_keys(left, ["k"], min_rows=1000).collect()] == [20]


def test_heavy_keys_are_few(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("k"))
    assert L.heavy_keys(df, ["k"], min_rows=1, parts=10).count() == 0


def test_lookup_beyond_the_limit_is_not_broadcast(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    small, large = L.lookup_join(left, right, "k"), L.lookup_join(left, right, "k", max_rows=10)
    assert rows(small) == rows(large)
    assert "BroadcastHashJoin [k" in plan(small)
    wide = right.withColumn("v", F.array_repeat(F.lit(1), 1000))
    assert not L.fits_broadcast(wide, max_bytes=10_000) and L.fits_broadcast(wide)
    assert L.fits_broadcast(right.limit(0))
    assert rows(L.lookup_or_default(left, right, "k", "v", 9)) == [(i, 1 if i < 50 else 9) for i in sorted(range(100), key=lambda i: repr((i, 1 if i < 50 else 9)))]


def test_joins_with_written_layers_are_not_broadcast(spark, tmp_path):
    # the files of these tables are tiny, as those of wide layers look when only their keys are read
    keys = spark.range(50).select(F.col("id").alias("k"), F.concat(F.lit("x"), "id").alias("v"), F.lit("v1").alias("version"))
    keys.write.parquet(f"{tmp_path}/layer")
    layer, more = spark.read.parquet(f"{tmp_path}/layer"), spark.range(60).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    joined = {
        "pending": increments.pending(more, layer, "k"), "version": increments.pending_for_version(more, layer, "k", "version", "v1"),
        "update": merge.merge_update(more, layer, "k", ["v"]), "lookup": L.lookup_join(more, layer.select("k", "version"), "k", max_rows=10),
        "none": more.join(layer.select("k", "version"), "k"),
    }
    texts = {name: "\n".join(x for x in plan(df).splitlines() if "Join" in x and "BuildRight, LeftOuter" not in x or "SortMergeJoin" in x) for name, df in joined.items()}
    assert "BroadcastHashJoin" in texts.pop("none")
    assert all("SortMergeJoin" in t for t in texts.values()), texts
    assert [joined[x].count() for x in ("pending", "version", "update", "lookup")] == [10, 10, 60, 60]
    assert rows(joined["update"].filter("v != 'y'")) == rows(layer.select("k", "v"))


def test_a_lookup_passes_on_what_its_rows_are_spread_by(spark):
    left = spark.range(40).select(F.col("id"), (F.col("id") % 3).alias("k"), F.lit("w").alias("wide"))
    right = spark.range(2).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    both = [L.lookup_join(left, right, "k", max_rows=n, spread=["id"], counted=left.select("k")) for n in (0, 10)]
    assert rows(both[0]) == rows(both[1]) == rows(left.join(right, "k", "left"))


def test_distance_candidates_are_not_broadcast(spark, tmp_path):
    spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "a double, b double").write.parquet(f"{tmp_path}/places")
    left = spark.read.parquet(f"{tmp_path}/places")
    pairs = spatial.grid_candidates(left, left.toDF("c", "d"), 300.0, ("a", "b"), ("c", "d"))
    assert "SortMergeJoin" in plan(pairs) and "BroadcastHashJoin" not in plan(pairs)
    assert rows(pairs.select("a", "c")) == [(0.0, 0.0), (1.0, 1.0)]


# ---------------------------------------------------------------- distance joins

@pytest.mark.parametrize("center", [(-36.8, -73.0), (10.0, 179.9999), (-89.9995, 20.0), (0.0, 0.0)])
def test_grid_join_equals_naive_join(spark, center):
    rnd = random.Random(5)

    def scatter(n):
        points = []
        for _ in range(n):
            lat = max(-90.0, min(90.0, center[0] + rnd.uniform(-0.01, 0.01)))
            lon = center[1] + rnd.uniform(-0.01, 0.01) * (1000 if abs(center[0]) > 89 else 1)
            points.append((lat, (lon + 180) % 360 - 180))
        return points

    left, right = scatter(120), scatter(150)
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(left)] + [(999, None, 1.0)], "i int, latitud double, longitud double")
    rdf = spark.createDataFrame([(j, *p) for j, p in enumerate(right)] + [(999, 1.0, None)], "j int, ref_latitud double, ref_longitud double")
    expected = {(i, j) for i, p in enumerate(left) for j, q in enumerate(right) if gap(p, q) <= 300}
    joined = spatial.distance_join(ldf, rdf, 300.0).select("i", "j", "distancia_m").collect()
    assert len(joined) == len(expected) and {(r["i"], r["j"]) for r in joined} == expected
    assert all(r["distancia_m"] == pytest.approx(gap(left[r["i"]], right[r["j"]]), abs=1e-3) for r in joined)


def test_crowded_cells_are_split_without_losing_pairs(spark):
    rnd = random.Random(9)
    pts = [(-36.8 + rnd.uniform(0, 0.002), -73.0 + rnd.uniform(0, 0.002)) for _ in range(400)]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, a double, b double")
    right = spark.createDataFrame([(j, *p) for j, p in enumerate(pts[:100])], "j int, c double, d double")
    whole = spatial.grid_candidates(left, right, 300.0, ("a", "b"), ("c", "d"))
    for together in (False, True):
        split = spatial.grid_candidates(left, right, 300.0, ("a", "b"), ("c", "d"), cell_pairs=500, whole=together)
        assert rows(split.select("i", "j")) == rows(whole.select("i", "j"))
        # 400 x 100 rows in a few cells: parts hash to about 500 pairs each
        largest = split.groupBy("__cy", "__cx", "__part").count().agg(F.max("count")).first()[0]
        assert split.select("__part").distinct().count() > 20 and largest <= 2_500


def test_right_sides_are_split_only_where_candidates_may_be_parted(spark):
    left = spark.createDataFrame([(0, -36.8, -73.0)], "i int, a double, b double")
    right = spark.range(3_000).select(F.col("id").alias("j"), (-36.8 + F.col("id") * 1e-9).alias("c"), F.lit(-73.0).alias("d"))
    apart = spatial.grid_candidates(left, right, 300.0, ("a", "b"), ("c", "d"), cell_pairs=500)
    assert apart.count() == 3_000 and apart.select("__part").distinct().count() == 6
    assert spatial.grid_candidates(left, right, 300.0, ("a", "b"), ("c", "d"), cell_pairs=500, whole=True).select("__part").distinct().count() == 1


def test_crowded_cells_are_cut_into_square_tiles(spark):
    rnd = random.Random(4)
    pts = [(-36.8 + rnd.uniform(0, 0.002), -73.0 + rnd.uniform(0, 0.002)) for _ in range(400)]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, a double, b double")
    right = spark.createDataFrame([(j, *p) for j, p in enumerate(pts)], "j int, c double, d double")
    split = spatial.grid_candidates(left, right, 300.0, ("a", "b"), ("c", "d"), cell_pairs=1600)
    sides = split.groupBy("__cy", "__cx", "__part").agg(F.countDistinct("i").alias("l"), F.countDistinct("j").alias("r")).agg(F.max("l"), F.max("r")).first()
    assert max(sides) <= 100  # not all 400 rows of one side in every part


def test_rows_of_a_few_crowded_cells_meet_without_being_repeated(spark, monkeypatch):
    rnd = random.Random(3)

    def scatter(n, lat, lon, size):
        return [(lat + rnd.uniform(0, size), (lon + rnd.uniform(0, size) + 180) % 360 - 180) for _ in range(n)]

    odd = [(math.nan, 0.0), (95.0, 10.0), (-36.8, math.nan), (-36.799, 287.001)] + [(-36.799, -72.999)] * 4
    left = scatter(200, -36.8, -73.0, 0.004) + scatter(30, -36.0, -72.0, 1) + scatter(60, 10.0, 179.999, 0.002) + odd
    right = scatter(250, -36.8, -73.0, 0.004) + left[:40] + scatter(60, 10.0, 179.999, 0.002) + odd
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(left)] + [(999, None, 1.0)], "i int, latitud double, longitud double")
    rdf = spark.createDataFrame([(j, *p) for j, p in enumerate(right)] + [(999, 1.0, None)], "j int, ref_latitud double, ref_longitud double")
    exact = geo.within_m(F.col("latitud"), F.col("longitud"), F.col("ref_latitud"), F.col("ref_longitud"), 60.0)
    expected = rows(ldf.crossJoin(rdf).filter(exact).select("i", "j"))
    monkeypatch.setattr(spatial, "BLOCK_ROWS", 16)
    spots = spatial.distance_join(ldf, rdf, 60.0, cell_pairs=50)
    assert plan(spots).count("CartesianProduct") == 1 and "Union" in plan(spots)
    assert rows(spots.select("i", "j")) == expected and len(expected) > 2000
    monkeypatch.setattr(spatial, "FEW_CELLS", 2)  # too many crowded cells: tiles
    tiles = spatial.distance_join(ldf, rdf, 60.0, cell_pairs=50)
    assert "CartesianProduct" not in plan(tiles) and "BroadcastHashJoin" not in plan(tiles.select("i", "j")).split("Union")[0].split("SortMergeJoin")[0]
    assert rows(tiles.select("i", "j")) == expected
    monkeypatch.setattr(spatial, "SQUARE_ROWS", 2)
    monkeypatch.setattr(spatial, "FEW_CELLS", 64)
    assert rows(spatial.distance_join(ldf, rdf, 60.0, cell_pairs=50).select("i", "j")) == expected


def test_tiles_repeat_rows_a_few_times_on_average(spark, monkeypatch):
    monkeypatch.setattr(spatial, "COPIES", 2)
    counts = spark.createDataFrame([(0, i, 4000, 4000, 1.6e7) for i in range(3)], "__cy int, __cx int, __l int, __r int, __pairs double")
    _, cut = spatial._cut_cells(counts, 100, False, spatial.TESTED_PAIRS)
    copies = cut.join(counts, ["__cy", "__cx"]).agg(F.sum(F.col("__l") * F.col("__rights") + F.col("__r") * F.col("__lefts"))).first()[0]
    assert 24_000 < copies <= 3 * 24_000  # 100 pairs a tile would repeat each row 400 times


def test_pairs_at_the_radius_are_decided_as_by_the_exact_test(spark):
    rnd = random.Random(8)
    here, pairs = (-36.8, -73.0), []
    for _ in range(300):
        angle, far = rnd.uniform(0, 2 * math.pi), 300.0 + rnd.choice([0.0, 1e-9, -1e-9, 1e-6, -1e-6, 1.0, -1.0])
        step = math.degrees(far / 6_371_000.0)
        pairs.append((*here, here[0] + step * math.sin(angle), here[1] + step * math.cos(angle) / math.cos(math.radians(here[0]))))
    pairs += [(95.0, 10.0, 95.0, 10.001), (1e17, 0.0, 1e17, 0.0), (math.nan, 0.0, 0.0, 0.0), (0.0, 179.9999, 0.0, -179.9999), (0.0, 0.0, 0.0, 180.0), (1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    for radius in (300.0, 1e-3, 3e7):
        exact = geo.within_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"), radius)
        near = geo.near_m(geo.unit_vector(F.col("a"), F.col("b")), geo.unit_vector(F.col("c"), F.col("d")), exact, radius)
        assert df.filter(~near.eqNullSafe(exact)).collect() == []


def test_neighbour_median_counts_copies(spark):
    place = (-36.8, -73.0)
    reference = spark.createDataFrame(
        [(*place, 1.0)] * 3 + [(place[0] + 0.001, place[1], 5.0)] * 2 + [(place[0] + 0.1, place[1], 99.0), (*place, None)],
        "latitud double, longitud double, v double",
    )
    probes = spark.createDataFrame([place] * 50 + [(None, 1.0), (10.0, 10.0)], "latitud double, longitud double")
    got = spatial.neighbour_median(probes, reference, "v", 300.0, "m", count="n").collect()
    assert [tuple(r) for r in got] == [(*place, 1.0, 5)]


def test_grid_join_plan_has_no_nested_loop_over_the_data(spark):
    pts = spark.createDataFrame([(1.0, 1.0)], "latitud double, longitud double")
    ref = spark.createDataFrame([(1.0, 1.0, 2.0)], "latitud double, longitud double, v double")
    text = plan(spatial.neighbour_median(pts, ref, "v", 300.0, "m"))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    # nothing is shuffled between the join and the selection
    head = text[: text.index("SortMergeJoin")]
    assert "Exchange" not in head


# ---------------------------------------------------------------- polygons

SQUARES = [
    ("b", "POLYGON ((-74 -37, -73 -37, -73 -36, -74 -36, -74 -37), (-73.75 -36.75, -73.25 -36.75, -73.25 -36.25, -73.75 -36.25, -73.75 -36.75))"),
    ("c", "MULTIPOLYGON (((-73.7 -36.7, -73.3 -36.7, -73.3 -36.3, -73.7 -36.3, -73.7 -36.7)), ((-72 -37, -71 -37, -71.5 -36, -72 -37)))"),
    ("a", "POLYGON ((-73.1 -36.9, -72.5 -36.9, -72.5 -36.5, -73.1 -36.5, -73.1 -36.9))"),
]


@pytest.mark.parametrize("cell_edges, max_rows", [(16, 100_000), (4, 100_000), (1, 100_000), (2, 0)])
def test_point_in_polygon(spark, cell_edges, max_rows):
    polygons = spark.createDataFrame(SQUARES, "k string, w string")
    points = {
        "inside": (-73.9, -36.5, "b"), "hole": (-73.72, -36.72, None), "in_hole_other": (-73.5, -36.5, "c"),
        "edge": (-73.5, -37.0, None), "left_edge": (-74.0, -36.5, None), "corner": (-74.0, -37.0, None), "hole_edge": (-73.5, -36.75, None),
        "second_part": (-71.5, -36.8, "c"), "overlap": (-73.05, -36.8, "a"), "outside": (-70.0, -30.0, None), "inner_edge": (-73.1, -36.6, "b"),
    }
    df = spark.createDataFrame([(n, y, x) for n, (x, y, _) in points.items()] + [("none", None, None)], "id string, latitud double, longitud double")
    edges = spatial.polygon_edges(polygons, "k", "w")
    got = dict(rows(spatial.point_in_polygon(df, edges, "id", "k", cell_edges=cell_edges, max_rows=max_rows)))
    assert got == {n: k for n, (_, _, k) in points.items() if k}


def inside(edges, x, y):
    odd = False
    for x1, y1, x2, y2 in edges:
        if min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2) and (y1 == y2 or (x2 - x1) * (y - y1) == (x - x1) * (y2 - y1)):
            return False
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


@pytest.mark.parametrize("cell_edges", [1, 3, 16])
def test_polygon_index_agrees_with_all_edges(spark, cell_edges):
    rng = random.Random(cell_edges)
    polygons = {}
    for k in range(12):
        lattice, n = k % 2 == 0, rng.choice([3, 8, 60])
        cx, cy, size = rng.uniform(-2, 2), rng.uniform(-2, 2), rng.choice([0.01, 1, 30])
        ring = []
        for i in range(n):
            r, t = size * rng.uniform(0.2, 1), 2 * math.pi * i / n
            x, y = cx + r * math.cos(t), cy + r * math.sin(t)
            ring.append((round(x * 8) / 8, round(y * 8) / 8) if lattice else (x, y))
        polygons[f"p{k:02d}"] = [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1])]
    points = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(300)] + [(i / 8, j / 8) for i in range(-16, 17, 2) for j in range(-16, 17, 2)]
    points += [(e[0], e[1]) for es in polygons.values() for e in es[:5]] + [(e[0], rng.uniform(-3, 3)) for es in polygons.values() for e in es[:5]]
    edges = spark.createDataFrame([(k, *e) for k, es in polygons.items() for e in es], "k string, x1 double, y1 double, x2 double, y2 double")
    df = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(points)], "id int, latitud double, longitud double")
    want = {}
    for i, (x, y) in enumerate(points):
        for k in sorted(polygons):
            if inside(polygons[k], x, y):
                want[i] = k
                break
    assert dict(rows(spatial.point_in_polygon(df, edges, "id", "k", cell_edges=cell_edges))) == want


def test_polygon_index_grows_with_edges_not_with_extent(spark):
    coast = [(math.cos(2 * math.pi * i / 2000) * 40, math.sin(2 * math.pi * i / 2000) * 40) for i in range(2000)]
    rings = {"continent": [(-80, -56), (-34, -7), (-80, 12)], "island": [(0, 0), (0.001, 0), (0, 0.001)], "coast": coast}
    edges = [(k, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for k, r in rings.items() for a, b in zip(r, r[1:] + r[:1])]
    index = spatial.polygon_index(spark.createDataFrame(edges, "k string, x1 double, y1 double, x2 double, y2 double"), "k")
    sizes = {r["k"]: (r["cells"], r["edges"]) for r in index.groupBy("k").agg(F.count(F.lit(1)).alias("cells"), F.sum(F.size("__edges")).alias("edges")).collect()}
    assert sizes["continent"][0] <= 4 and sizes["island"][0] <= 4
    assert sizes["coast"][0] <= 2000 and sizes["coast"][1] <= 3 * 2000
    empty = spark.createDataFrame([], "k string, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id int, latitud double, longitud double")
    assert spatial.point_in_polygon(points, empty, "id", "k").collect() == []


# ---------------------------------------------------------------- ranks

def test_order_keys_are_the_bits_of_the_numbers(spark):
    rng = random.Random(2)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.0000000000000002, 0.9999999999999999, 1.7976931348623157e308, float("inf"), 8.0, 7.999999999999999, 3e-310]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(62)))[0] for _ in range(2000)]
    values += [2.0**e for e in range(-1074, 1024, 7)] + [math.nextafter(2.0**e, 0) for e in range(-1073, 1024, 7)]
    values = [v for v in values + [-v for v in values if v] if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", Q.order_key(F.col("v")).alias("k"))
    for r in df.collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["k"] == (-bits if r["v"] < 0 else bits), r["v"]


@pytest.mark.parametrize("budget", [10, 300, 65_536])
def test_radix_selection_against_sorting(spark, budget):
    rng = random.Random(budget)
    data = [("narrow", 1.7e9 + rng.random()) for _ in range(900)] + [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(700)]
    data += [("few", float(rng.randrange(5))) for _ in range(500)] + [(None, rng.gauss(0, 1)) for _ in range(400)] + [("one", 7.0), ("none", None), ("none", float("nan"))]
    data += [("edge", x) for x in (float("inf"), float("-inf"), 0.0, -0.0, 5e-324)]
    got = Q.rank_select(spark.createDataFrame(data, "g string, v double"), ["g"], "v", {"low": lambda n: F.lit(1), "mid": lambda n: F.ceil(n / 2), "top": lambda n: n}, budget=budget)
    by = {}
    for g, v in data:
        if v is not None and v == v:
            by.setdefault(g, []).append(v)
    want = {g: (len(v), sorted(v)[0], sorted(v)[-(-len(v) // 2) - 1], sorted(v)[-1]) for g, v in by.items()}
    assert {r["g"]: tuple(r)[1:] for r in got.collect()} == want


# ---------------------------------------------------------------- merges and increments

def frame(spark, data):
    return spark.createDataFrame(data, "id int, v string")


def test_merges(spark):
    target, source = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, None), (3, "c")])
    once = merge.merge_upsert(target, source, "id")
    assert rows(once) == [(1, "a"), (2, None), (3, "c")]
    assert rows(merge.merge_upsert(once, source, "id")) == rows(once)
    assert rows(merge.merge_insert_only(target, source, "id")) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(merge.merge_insert_only(None, source, "id")) == [(2, None), (3, "c")]
    assert rows(merge.merge_update(target, source, "id", ["v"])) == [(1, "a"), (2, None)]
    assert rows(merge.replace_rows(target, F.col("v") == "a", frame(spark, [(9, "z")]))) == [(2, "b"), (9, "z")]
    both = merge.backfill(target, source, "id")
    assert rows(both) == [(1, "a"), (2, None), (3, "c")] and rows(merge.backfill(target, both, "id")) == rows(both)


def test_deleting_keeps_rows_whose_condition_is_unknown(spark):
    df = frame(spark, [(1, None), (2, "x")])
    assert rows(merge.replace_rows(df, F.col("v") == "x", df.limit(0))) == [(1, None)]


def test_evolution(spark):
    df = merge.ensure_columns(frame(spark, [(1, "a")]), {"v": "string", "n": "int", "t": "timestamp"})
    assert df.dtypes == [("id", "int"), ("v", "string"), ("n", "int"), ("t", "timestamp")]
    assert quality.schema_diff(df, frame(spark, [])) == [("n", "int", None), ("t", "timestamp", None)]


def test_guards(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (2, "c")])
    assert rows(quality.duplicate_keys(df, ["id"])) == [(1, 2)]
    with pytest.raises(ValueError, match="several rows"):
        quality.require_unique(df, ["id"], "source")
    with pytest.raises(ValueError, match="empty"):
        quality.require_rows(df.limit(0), "polygons")
    with pytest.raises(Exception, match="must not be null"):
        quality.require_not_null(spark.createDataFrame([(None, "a")], "id int, v string"), ["id"]).collect()


def test_retry_limit_is_inclusive(spark):
    listings = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", "u"), ("d", None), ("e", "u"), ("f", "u")], "id_aviso string, url string")
    log = [("a", "error")] * 5 + [("b", "error")] * 6 + [("c", "no_encontrado")] + [("f", "ok")] * 9
    attempts = spark.createDataFrame(log, "id_aviso string, resultado string")
    queue = increments.retry_queue(listings, spark.createDataFrame([("e",)], "id_aviso string"), attempts)
    assert rows(queue.select("id_aviso", "fallos")) == [("a", 5), ("f", 0)]


def test_plans_of_increments_and_dedupe(spark):
    df = frame(spark, [(1, "a")])
    assert "LeftAnti" in plan(increments.pending(df, df, "id"))
    ranked = plan(dedupe.keep_latest(df, ["id"], ["v"]))
    assert ranked.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert "TakeOrderedAndProject" in plan(dedupe.newest(df, "v", "id", 3))


# ---------------------------------------------------------------- publication state

def replay(events, limit=5):
    """Outcome by outcome, as one visit after the other would do it."""
    states = {}
    for id_, ts, seq, result, seen in sorted(events, key=lambda e: (e[1], e[2])):
        state, failures, checked = states.get(id_, ("activo", 0, None))
        if result == "captcha":
            continue
        if state == "activo":
            checked = ts
            if result == "ok":
                state, failures = seen or "activo", 0
            elif result == "no_encontrado":
                state, failures = "no_disponible", 0
            else:
                failures += 1
                if failures > limit:
                    state, failures = "no_disponible", 0
        states[id_] = (state, failures, checked)
    return sorted((k, *v) for k, v in states.items())


@pytest.mark.parametrize("segments", [1, 4, 13])
def test_fold_equals_replay(spark, segments):
    import datetime as dt

    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    events = []
    for n in range(3000):
        id_ = 0 if n % 3 == 0 else rnd.randrange(1, 120)  # one listing holds a third
        result = rnd.choices(["error", "ok", "captcha", "no_encontrado"], [60, 35, 4, 0 if id_ == 0 else 1])[0]
        if id_ == 0 and result == "error" and n % 4 == 0:
            result = "ok"
        seen = "pausado" if result == "ok" and id_ and rnd.random() < 0.05 else None
        events.append((id_, start + dt.timedelta(minutes=rnd.randrange(5000)), n, result, seen))
    df = spark.createDataFrame(events, "id long, ts timestamp, seq long, resultado string, estado string")
    got = sorted(tuple(r) for r in fold_states(df, segments=segments).collect())
    assert got == replay(events)
    # two parts, the second on top of the first
    cut = start + dt.timedelta(minutes=2500)
    first = fold_states(df.filter(F.col("ts") < F.lit(cut)), segments=segments)
    second = fold_states(df.filter(F.col("ts") >= F.lit(cut)), initial=first, segments=segments)
    assert sorted(tuple(r) for r in second.collect()) == replay(events)


def test_captcha_stops_the_run(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP'2024-01-01 01:00:00', 1, 'ok'), (1, TIMESTAMP'2024-01-01 02:00:00', 2, 'captcha'),"
        "(1, TIMESTAMP'2024-01-01 03:00:00', 3, 'ok'), (2, TIMESTAMP'2024-01-01 04:00:00', 4, 'error') t(run, ts, seq, resultado)"
    )
    assert sorted(r["seq"] for r in captcha_prefix(df).collect()) == [1, 4]


# ---------------------------------------------------------------- scoring

def test_ensemble_uses_population_deviation_and_floor(spark):
    df = spark.createDataFrame([(2.0, 4.0), (-3.0, -1.0)], "a double, b double")
    got = [(r["costo_total_predicho"], r["cv_ensamble"]) for r in scoring.score_ensemble(df, [F.col("a"), F.col("b")]).collect()]
    assert got == [(3.0, pytest.approx(1 / 3)), (0.0, 0.0)]


def test_calibration_document(spark):
    text = (
        '{"bordes_deciles_precio":[0,10,20],"stats_por_decil":{"0":{"mediana_error":1,"mad_error":2},"1":{"mediana_error":0,"mad_error":0}},'
        '"bordes_cv_confianza":[0,0.5,9],"etiquetas_confianza":["alta","baja"],"mad_scale_const":1,"umbral_oportunidad":1,"umbral_caro":1}'
    )
    calibration = scoring.read_calibration(spark.createDataFrame([(text,)], "document string"))
    df = spark.createDataFrame([(10.0, 3.0, 0.5), (20.0, 20.0, 0.6), (30.0, 1.0, 0.1)], "costo_total_real double, costo_total_predicho double, cv_ensamble double")
    got = [tuple(r) for r in scoring.calibrate(df, calibration).select("decil_precio", "z_robusto", "etiqueta", "nivel_confianza").collect()]
    assert got == [(0, 3.0, "caro", "alta"), (1, 0.0, "precio_de_mercado", "baja"), (None, None, None, "alta")]


def test_outside_model(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    score = scoring.external_scorer(lambda p: p["x"] * 2 + 1, ["x"])
    assert [r[0] for r in df.select(score.alias("y")).collect()] == [2.0 * i + 1 for i in range(10)]


def test_imputation_marks_only_filled_rows(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    got = scoring.impute_with_model(df, "v", F.lit(9.0), "f", "t", F.lit("2024-01-01").cast("timestamp")).collect()
    assert [(r["v"], r["f"], r["t"] is None) for r in got] == [(1.0, None, True), (9.0, True, False)]


def test_a_merge_source_with_a_key_twice_fails(spark):
    from listing_lake.operators.merge import merge_update, merge_upsert

    target = spark.createDataFrame([(1, "a")], "k int, x string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, x string")
    for merged in (merge_upsert(target, twice, "k"), merge_update(target, twice, "k", ["x"])):
        with pytest.raises(Exception, match="several source rows for key"):
            merged.collect()
