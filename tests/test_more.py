"""Regions, filters, pipelines, sinks and the command line against brute force and in their edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.__main__ import main
from fieldloom.functions import sequence, time as tm
from fieldloom.operators import aggregates, batch, dualtree, filters, joins, pipelines
from fieldloom.sources import catalog, readers, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def inside(px, py, rings):
    odd = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_points_in_regions_match_brute_force(spark):
    r = random.Random(3)
    star = lambda cx, cy, a, b, n: [(cx + (a if i % 2 else b) * np.cos(2 * np.pi * i / n), cy + (a if i % 2 else b) * np.sin(2 * np.pi * i / n)) for i in range(n)]
    shapes = {"star": [star(0, 0, 9, 4, 22), star(0, 0, 2, 1, 10)], "two": [star(20, 3, 5, 5, 6), star(-20.5, -3.5, 0.2, 0.1, 8)], "island": [star(40, 0, 8, 8, 12), star(40, 0, 6, 6, 12), star(40, 0, 2, 2, 12)], "line": [[(1.0, 1.0), (2.0, 2.0)]], "empty": []}
    regions = spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in ring] for ring in v]) for k, v in shapes.items()] + [(None, None)], "name string, rings array<array<struct<x double, y double>>>")
    points = [(i, r.uniform(-11, 11), r.uniform(-30, 50)) for i in range(1500)] + [(2000, None, 1.0), (2001, float("nan"), 1.0), (2002, -3.5, -20.5)]
    got = rows(joins.points_in_regions(spark.createDataFrame(points, "i long, lat double, lon double"), "lat", "lon", regions, "name", "rings", 1.5).select("i", "name"))
    want = sorted(((i, k) for i, la, lo in points if la is not None and la == la for k, v in shapes.items() if inside(lo, la, [q for q in v if len(q) > 2])), key=repr)
    assert got == want and {k for _, k in want} == {"star", "two", "island"}


def test_hot_cells_of_both_sides_are_split(spark, monkeypatch):
    monkeypatch.setattr(dualtree, "hot_keys", lambda *a, **k: __import__("fieldloom.skew", fromlist=["x"]).hot_keys(*a, **{**k, "least": 10}))
    left = spark.range(120).select(F.col("id").alias("k"), F.lit(50.0).alias("latitude"), F.lit(8.0).alias("longitude"))
    right = spark.range(150).select(F.col("id").alias("r"), F.lit(50.001).alias("latitude"), F.lit(8.0).alias("longitude"))
    assert dualtree.dual_tree_pairs(left, right, 1.0, "k", "r").count() == 120 * 150


def test_next_values_over_partitions(spark):
    r = random.Random(5)
    v = [r.randrange(1000) for _ in range(300)] + [None]
    got = dict(rows(aggregates.with_next(spark.createDataFrame([(x,) for x in v], "v int"), "v", "n")))
    want = sorted({x for x in v if x is not None})
    assert got == dict(zip(want, want[1:] + [None]))
    assert aggregates.with_next(spark.createDataFrame([], "v int"), "v", "n").count() == 0


def test_every_pair_of_regions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "a"), (3, None)], "s int, r string")
    assert rows(aggregates.beta_jaccard(df, "s", "r")) == [("a", "a", 0.0), ("a", "b", 0.0), ("b", "a", 0.0), ("b", "b", 0.0), ("c", "c", 0.0)]
    assert ("a", "c", 1.0) in rows(aggregates.beta_jaccard(df, "s", "r", every=True)) and len(rows(aggregates.beta_jaccard(df, "s", "r", every=True))) == 9


def test_nearest_point_in_one_crowded_place(spark):
    rng = np.random.default_rng(4)
    b = np.concatenate([rng.uniform(0, 1e-6, (300, 2)), [[80.0, 80.0]]])
    a = rng.uniform(-50, 90, (60, 2))
    got = {(r["la"], r["lo"]): r["k"] for r in joins.nearest_point(spark.createDataFrame(a.tolist(), "la double, lo double"), "la", "lo", spark.createDataFrame([(int(i), *map(float, p)) for i, p in enumerate(b)], "k int, pa double, po double"), "pa", "po", "k").collect()}
    for p, k in got.items():
        d = np.sqrt(((b - p) ** 2).sum(1))
        assert d[k] <= d.min() * (1 + 1e-9)
    assert len(got) == 60


def test_filters_of_nulls_and_bounds(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), None), (3, None, "x"), (4, 2.0, "y")], "i int, a double, b string")
    assert [r["i"] for r in filters.without_nulls(df, ["a", "b"]).collect()] == [4] and sorted(r["i"] for r in filters.without_nulls(df, ["a", "b"], "all").collect()) == [1, 3, 4]
    t = spark.createDataFrame([("2020-02-01 00:00:00",), ("2020-01-02 00:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert filters.day_first_bounds(t, "t", "01/02/2020").count() == 1 and filters.day_first_bounds(t, "t").count() == 3 and filters.day_first_bounds(t, "t", end="no date").count() == 0
    assert filters.years_between(t, F.year("t"), 2020).count() == 2 and filters.years_between(t, F.year("t"), None, 2019).count() == 0
    v = spark.createDataFrame([("edaphic_variables", "foo"), ("edaphic_variables", "stl1"), ("other", "foo"), (None, "foo")], "s string, v string")
    assert filters.taken_variables(v, "s", "v").count() == 3


def test_assertions_fail_the_query(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert rows(filters.assertions(df, {"there": F.col("v").isNotNull(), "small": F.col("v") < 5}, fail=False)) == [("small", 2, 1), ("there", 2, 1)]
    with pytest.raises(Exception, match="check failed"):
        filters.assertions(df, {"there": F.col("v").isNotNull()}).collect()
    with pytest.raises(Exception, match="key sets differ"):
        filters.combined_metrics({"a": df.select("v", F.lit(1.0).alias("m")), "b": spark.createDataFrame([(1, 2.0)], "v int, m double")}, ["v"], "m").collect()


def test_half_days_in_any_letter_case(spark):
    df = spark.createDataFrame([("PM",), ("pm",), ("Am",), ("Dawn",), ("dawn",)], "t string")
    assert [r[0] for r in df.select(tm.free_clock(F.col("t"))).collect()] == ["12:00", "12:00", "00:00", "06:00", "00:00"]


def test_stacked_windows_fill_gaps(spark):
    df = spark.createDataFrame([("2020-01-01", "s", "b", 1, 0, 5.0), ("2020-01-01", "s", "a", 1, 0, 6.0), ("2020-01-02", "s", "a", 1, 1, float("nan")), ("2020-01-02", "s", "a", 1, 0, 7.0), (None, "s", "a", 1, 0, 1.0)], "t string, s string, v string, l int, c int, x double")
    one = lambda fill: batch.stacked_windows(df.withColumn("t", F.col("t").cast("timestamp")), "t", "s", "v", "l", ["c"], "x", fill).first()
    assert one(0.0)["tensor"] == [6.0, 0.0, 5.0, 0.0, 7.0, 0.0, 0.0, 0.0] and one(0.0)["variables"] == ["a", "b"]
    assert one(None)["tensor"] == [6.0, None, 5.0, None, 7.0, None, None, None]


def test_kmer_vectors(spark):
    r = random.Random(2)
    seqs = ["".join(r.choice("ACGTN") for _ in range(40)), "ACG", "", None, "AAAAA"]
    got = [x["v"] for x in spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string").select("i", sequence.kmer_vector(F.col("s"), 4).alias("v")).orderBy("i").collect()]
    for s, v in zip(seqs, got):
        s = s or ""
        want = np.zeros(256)
        for i in range(len(s) - 3):
            if set(s[i : i + 4]) <= set("ACGT"):
                want[int(s[i : i + 4].translate(str.maketrans("ACGT", "0123")), 4)] += 1 / (len(s) - 3)
        assert np.allclose(v, want)


def test_pipelines_of_odd_values(spark):
    df = spark.createDataFrame([(1, "ACGTNNNN", [1.0] * 64), (2, None, None), (3, "", []), (4, "acgtacgt", [0.0] * 192)], "i int, s string, v array<double>")
    got = {r["i"]: r for r in df.select("i", pipelines.dna_features(F.col("s"), 2).alias("d"), pipelines.wave_features(F.col("v"), 8000).alias("w"), pipelines.image_pipeline(F.col("v"), 8, 8, 3, 8).alias("p")).collect()}
    assert got[1]["d"] is None and sum(got[2]["d"]) == 0 and sum(got[4]["d"]) == pytest.approx(1.0)
    assert got[2]["w"] is None and len(got[3]["w"]) == 13 and np.isfinite(got[1]["w"]).all()
    assert got[1]["p"] is None and len(got[4]["p"]["histogram"]) == 24 and got[4]["p"]["edge"] == 0.0


def test_image_and_wave_changes_are_repeatable():
    x = np.arange(48.0).reshape(4, 4, 3) * 5
    assert np.allclose(pipelines.augmented_image(x, 3), pipelines.augmented_image(x, 3)) and pipelines.augmented_image(x, 1).shape == (4, 4, 3)
    w = np.sin(np.arange(100))
    assert np.allclose(pipelines.augmented_wave(w, 2), pipelines.augmented_wave(w, 2)) and not np.allclose(pipelines.augmented_wave(w, 2), pipelines.augmented_wave(w, 5))
    spike = np.zeros((5, 5))
    spike[2, 2] = 9
    assert pipelines.denoised(spike).max() == 0
    hsv = pipelines.colour_space(np.array([[[255.0, 0, 0], [0, 255.0, 0], [0, 0, 255.0], [10.0, 10, 10]]]))
    assert hsv[0, :, 0].tolist() == [0, 120, 240, 0] and hsv[0, 3, 1] == 0


def test_taxonomy_from_several_sources(spark):
    x = spark.createDataFrame([("a", "own"), ("b", None), ("c", "own")], "k string, genus string")
    dna = spark.createDataFrame([("a", "g1", "p1"), ("b", "Unknown", None)], "k string, genus string, phylum string")
    meta = spark.createDataFrame([("a", "g2", "f2"), ("b", "g3", "f3"), ("b", "g9", None)], "k string, genus string, family string")
    got = rows(joins.taxonomy(x, [dna, meta], "k").select("k", "phylum", "family", "genus"))
    assert got == [("a", "p1", "f2", "g1"), ("b", "Unknown", "f3", "g3"), ("c", "Unknown", "Unknown", "own")]


def test_windows_left_in_part_are_written_again(spark, tmp_path):
    out = str(tmp_path / "w")
    df = spark.range(40).select((F.col("id") % 4).cast("string").alias("window_start"), "id")
    df.filter("window_start = '1' AND id < 20 OR window_start = '2'").write.partitionBy("window_start").parquet(out)
    sinks.write_new_windows(df, out)
    assert rows(spark.read.parquet(out).groupBy("window_start").count()) == [(0, 10), (1, 10), (2, 10), (3, 10)]
    before = {r["f"] for r in spark.read.parquet(out).select(F.input_file_name().alias("f")).distinct().collect()}
    sinks.write_new_windows(df, out)
    assert before == {r["f"] for r in spark.read.parquet(out).select(F.input_file_name().alias("f")).distinct().collect()}


def test_files_of_a_large_value_are_split(spark, tmp_path):
    out = str(tmp_path / "p")
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise(None).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which joins such small parts again
    try:
        sinks.write_parquet(df, out, ["k"], rows_a_file=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    x = spark.read.parquet(out)
    assert x.count() == 1000 and x.filter("k = 'hot'").select(F.input_file_name()).distinct().count() > 2


def test_folder_discovery_and_files_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "a.nc").write_bytes(b"CDF\x01rest")
    (tmp_path / "b.nc").write_bytes(b"nothing")
    (tmp_path / "c.parquet").write_bytes(b"PAR1cut off")
    assert rows(catalog.probe(spark, str(tmp_path)).select("kind", "valid")) == [("nc", False), ("nc", True), ("parquet", False)]


def test_regions_of_a_multipolygon_keep_their_holes(spark, tmp_path):
    p = tmp_path / "g.json"
    p.write_text('{"features": [{"properties": {"name": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[4,0],[4,4],[0,4]], [[1,1],[2,1],[2,2],[1,2]]], [[[9,9],[10,9],[10,10]]]]}}, {"properties": {"name": "n"}, "geometry": null}]}')
    r = readers.regions(spark, str(p))
    assert {x["name"]: x["rings"] and len(x["rings"]) for x in r.collect()} == {"m": 3, "n": None}
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 9.5, 9.7)], "i int, lat double, lon double")
    assert [x["i"] for x in joins.points_in_regions(points, "lat", "lon", r, "name", "rings").orderBy("i").collect()] == [1, 3]


def test_command_line_of_single_chunks(spark, tmp_path, capsys):
    cube = str(tmp_path / "cube")
    spark.range(60).select(F.expr("timestamp '2020-01-01' + make_dt_interval(cast(id % 6 AS INT))").alias("time"), "id", F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("value")).write.parquet(cube)
    main(["get-max-index", "--cube", cube, "--chunk", "2"])
    assert capsys.readouterr().out.strip().endswith("2")
    main(["run-single", "--cube", cube, "--out", str(tmp_path / "w"), "--index", "1", "--chunk", "2", "--fill-nan", "-1"])
    w = spark.read.parquet(str(tmp_path / "w"))
    assert w.select("window_start").distinct().count() == 2 and w.filter("value IS NULL").count() == 0 and w.filter("value = -1").count() > 0


def test_netcdf_files_with_records_and_scales(spark, tmp_path):
    """A file with a record dimension, two interleaved record variables, packed numbers and a fill value, laid out by hand."""
    import struct

    from fieldloom.sources import classic

    text = lambda s: struct.pack(">i", len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    units = "days since 2000-01-01"
    times = struct.pack(">ii", 12, 1) + text("units") + struct.pack(">ii", 2, len(units)) + units.encode() + b"\0" * (-len(units) % 4)
    packed = struct.pack(">ii", 12, 3) + text("scale_factor") + struct.pack(">iid", 6, 1, 0.5) + text("add_offset") + struct.pack(">iid", 6, 1, 10.0) + text("_FillValue") + struct.pack(">iih2x", 3, 1, -9)

    def header(b):
        out = b"CDF\x01" + struct.pack(">i", 3) + struct.pack(">ii", 10, 3) + text("time") + struct.pack(">i", 0) + text("latitude") + struct.pack(">i", 2) + text("longitude") + struct.pack(">i", 1) + struct.pack(">ii", 0, 0)
        out += struct.pack(">ii", 11, 4)
        out += text("latitude") + struct.pack(">ii", 1, 1) + struct.pack(">ii", 0, 0) + struct.pack(">iii", 5, 8, b[0])
        out += text("longitude") + struct.pack(">ii", 1, 2) + struct.pack(">ii", 0, 0) + struct.pack(">iii", 6, 8, b[1])
        out += text("time") + struct.pack(">ii", 1, 0) + times + struct.pack(">iii", 4, 4, b[2])
        return out + text("x") + struct.pack(">iiii", 3, 0, 1, 2) + packed + struct.pack(">iii", 3, 4, b[3])

    n = len(header([0] * 4))
    content = header([n, n + 8, n + 16, n + 20]) + struct.pack(">ffd", 50.0, 51.0, 359.0) + b"".join(struct.pack(">ihh", t, a, b) for t, a, b in ((0, 2, 4), (31, -9, 6), (62, 8, 10)))
    v, _ = classic.read(content)
    assert v["x"].values()[:, :, 0].tolist()[0] == [11.0, 12.0] and np.isnan(v["x"].values()[1, 0, 0]) and v["x"].values()[2, 1, 0] == 15.0
    (tmp_path / "a.nc").write_bytes(content)
    got = rows(readers.netcdf(spark, str(tmp_path), ["x"], ["2000-02", "2000-03"]).select(F.date_format("time", "yyyy-MM-dd"), "latitude", "longitude", "value"))
    assert got == sorted([("2000-02-01", 50.0, -1.0, None), ("2000-02-01", 51.0, -1.0, 13.0), ("2000-03-03", 50.0, -1.0, 14.0), ("2000-03-03", 51.0, -1.0, 15.0)], key=repr)
    assert rows(readers.ndvi_points(spark, str(tmp_path), "x").select("month_year", "latitude", "ndvi"))[0] == ("01/2000", 50.0, 11.0)
    again, notes = classic.read(classic.write({"a": classic.Variable(["i", "j"], np.arange(6).reshape(2, 3), {"n": "né", "k": 2.5}), "b": classic.Variable(["j"], np.array([1.5, 2.5, np.nan]))}, {"title": "t"}))
    assert again["a"].data.tolist() == [[0, 1, 2], [3, 4, 5]] and again["a"].attributes["n"] == "né" and np.isnan(again["b"].data[2]) and notes == {"title": "t"}
    with pytest.raises(ValueError):
        classic.read(b"no such file")
