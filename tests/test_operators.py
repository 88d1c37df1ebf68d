"""Edge semantics of functions, joins, readers, sinks, streams and media features."""

import io
import json
import math
import wave
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import codec, geo, media, sequence, stem, text
from fieldloom.functions import time as tm
from fieldloom.operators import aggregates, batch, grid, joins, reshape
from fieldloom.skew import salted_join
from fieldloom.sources import catalog, readers, sinks
from fieldloom.streaming import observations


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


# Functions


def test_snap_is_half_even_and_idempotent(spark):
    got = [one(spark, geo.snap(F.lit(v))) for v in (0.125, 0.375, -0.125, 10.1, 10.25)]
    assert got == [0.0, 0.5, -0.0, 10.0, 10.25]
    assert one(spark, geo.snap(geo.snap(F.lit(12.34)))) == one(spark, geo.snap(F.lit(12.34)))


def test_longitudes(spark):
    assert [one(spark, geo.wrap_lon(F.lit(v))) for v in (180.0, -180.0, 540.0, -190.0)] == [-180.0, -180.0, -180.0, 170.0]
    assert [one(spark, geo.canonical_lon(F.lit(v))) for v in (360.0, 180.0, 179.9)] == [0.0, -180.0, 179.9]


def test_laea_sample_point(spark):
    lat, lon = geo.laea_inverse(F.lit(3962799.45), F.lit(2999718.85))
    r = spark.range(1).select(lat.alias("a"), lon.alias("b")).first()
    assert abs(r["a"] - 50) < 1e-7 and abs(r["b"] - 5) < 1e-7


def test_slots(spark):
    cases = {"2020-01-01 03:00:00": 0, "2020-01-01 03:01:00": 6, "2020-01-01 09:00:59": 6, "2020-01-01 20:59:00": 18, "2020-01-01 23:59:00": 18, "2020-01-01 00:00:00": 0}
    for t, h in cases.items():
        got = one(spark, tm.six_hour_slot(F.lit(t).cast("timestamp")))
        assert (got.hour, got.day) == (h, 1), t


def test_sequences(spark):
    assert one(spark, sequence.clean_dna(F.lit(None).cast("string"))) == ""
    assert one(spark, sequence.replace_ambiguous(F.lit("AN"), 0.1)) is None and one(spark, sequence.replace_ambiguous(F.lit("AN"), 0.5)) == "AA"
    v = one(spark, sequence.kmer_vector(F.lit("ACGT"), 2))
    assert len(v) == 16 and math.isclose(sum(v), 1) and v[1] == pytest.approx(1 / 3)
    assert one(spark, sequence.kmers(F.lit("AC"), 3)) == []
    assert one(spark, sequence.l1_normalised(F.array(F.lit(0.0), F.lit(0.0)))) == [0.0, 0.0]


def test_text(spark):
    assert one(spark, text.tokens(F.lit(None).cast("string"))) == [] and one(spark, text.tokens(F.lit(" \n "))) == []
    assert one(spark, text.ngrams(F.array(F.lit("a")), 2)) == [] and one(spark, text.ngrams(text.tokens(F.lit("a, b c")), 2)) == ["a b", "b c"]


# Pairs of word and stem published with the algorithm.
STEMS = "caresses:caress ponies:poni ties:ti caress:caress cats:cat feed:feed agreed:agre plastered:plaster bled:bled motoring:motor sing:sing conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall hissing:hiss fizzed:fizz failing:fail filing:file happy:happi sky:sky relational:relat conditional:condit rational:ration digitizer:digit vietnamization:vietnam predication:predic operator:oper feudalism:feudal decisiveness:decis hopefulness:hope formaliti:formal sensibiliti:sensibl triplicate:triplic formative:form formalize:formal electrical:electr hopeful:hope goodness:good revival:reviv allowance:allow inference:infer airliner:airlin adjustable:adjust defensible:defens irritant:irrit replacement:replac adjustment:adjust dependent:depend adoption:adopt communism:commun activate:activ effective:effect bowdlerize:bowdler probate:probat rate:rate cease:ceas controll:control roll:roll"


def test_stemmer_on_published_pairs(spark):
    assert {w: stem.stem(w) for w, _ in (p.split(":") for p in STEMS.split())} == dict(p.split(":") for p in STEMS.split())
    df = spark.createDataFrame([(["cats", "hopping"],), (None,)], "w array<string>")
    assert [r["s"] for r in df.select(stem.stemmed("w").alias("s")).collect()] == [["cat", "hop"], None]


def test_codec_and_pca(spark):
    df = spark.createDataFrame([(1, [1.5, -2.0]), (2, None), (3, [])], "i int, v array<double>")
    back = {r["i"]: r["v"] for r in df.select("i", codec.from_base64(codec.to_base64("v")).alias("v")).collect()}
    assert back[1] == [1.5, -2.0] and back[2] is None
    assert spark.createDataFrame([("###",), ("YQ==",)], "t string").select(codec.from_base64("t").alias("v")).filter("v IS NOT NULL").count() == 0
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4)) * [5, 1, 0.5, 0.1]
    out = np.array([r["reduced"] for r in codec.reduced(spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>"), "v", 2).collect()])
    u, _, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(np.abs(out), np.abs(x @ vt[:2].T), atol=1e-6)


# Skew, grids and joins


def test_salted_join_equals_plain_join(spark):
    large = spark.range(2000).select(F.when(F.col("id") < 1500, 7).when(F.col("id") < 1990, F.col("id") % 50).cast("int").alias("k"), "id")
    dim = large.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    for how in ("left", "inner"):
        assert rows(salted_join(large, dim, ["k"], "n", F.col("id"), how, share=0.01, least=5)) == rows(large.join(dim.drop("n"), "k", how))


def test_nearest_slot_and_ties(spark):
    s = spark.createDataFrame([("2020-01-01 00:00:00",), ("2020-01-01 06:00:00",), ("2020-03-01 00:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    x = spark.createDataFrame([(1, "2020-01-01 03:00:00"), (2, "2019-05-01 00:00:00"), (3, "2021-01-01 00:00:00"), (4, None), (5, "2020-01-31 00:00:00"), (6, "2020-03-01 00:00:00")], "i int, t string").select("i", F.col("t").cast("timestamp_ntz").alias("t"))
    got = {r["i"]: str(r["slot"]) for r in joins.nearest_slot(x, "t", s, "t").collect()}
    assert got == {1: "2020-01-01 00:00:00", 2: "2020-01-01 00:00:00", 3: "2020-03-01 00:00:00", 4: "None", 5: "2020-01-01 06:00:00", 6: "2020-03-01 00:00:00"}
    assert joins.nearest_slot(x, "t", s.filter("false"), "t").filter("slot IS NOT NULL").count() == 0


def test_nearest_point_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    a, b = rng.uniform(-60, 60, (80, 2)), np.concatenate([rng.uniform(-60, 60, (15, 2)), rng.uniform(0, 1, (15, 2))])
    got = joins.nearest_point(spark.createDataFrame([tuple(map(float, p)) for p in a] + [(None, 1.0), (float("nan"), 1.0)], "la double, lo double"), "la", "lo", spark.createDataFrame([(*map(float, p), i) for i, p in enumerate(b)], "pa double, po double, k int"), "pa", "po", "k")
    got = {(r["la"], r["lo"]): r["k"] for r in got.collect()}
    assert got == {tuple(map(float, p)): int(np.argmin(((b - p) ** 2).sum(1))) for p in a}


def test_boxes_across_the_date_line_and_without_a_point(spark):
    b = spark.createDataFrame([("x", 0.0, 0.25, 179.75, -179.75), ("y", 1.01, 1.02, 2.01, 2.02)], "k string, a double, b double, c double, d double")
    got = rows(joins.cells_in_boxes(b, ["k"], "a", "b", "c", "d"))
    assert got == sorted([("x", i, j) for i in (0, 1) for j in (719, -720, -719)] + [("y", 4, 8)], key=repr)


def test_scatter_first_and_last(spark):
    df = spark.createDataFrame([(40.0, 10.0, 1, 5.0), (40.1, 10.1, 2, 6.0), (99.0, 10.0, 3, 7.0), (None, 1.0, 4, 1.0)], "lat double, lon double, o int, v double")
    assert rows(grid.scatter(df, grid.MONTHLY, "lat", "lon", "v", ["o"], "last").select("v")) == [(6.0,)]
    assert rows(grid.scatter(df, grid.MONTHLY, "lat", "lon", "v", ["o"], "first").select("v")) == [(5.0,)]
    assert (grid.DAILY.rows, grid.DAILY.columns, grid.MONTHLY.rows, grid.MONTHLY.columns) == (153, 321, 161, 281)


def test_moments_of_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None), ("a", 3.0), ("b", None), ("c", float("inf")), ("c", 1.0)], "k string, v double")
    got = {r["k"]: r for r in aggregates.moments(df, "v", ["k"]).collect()}
    assert (got["a"]["count_valid"], got["a"]["count_nan"], got["a"]["mean"], got["a"]["std"]) == (2, 2, 2.0, 1.0)
    assert (got["b"]["mean"], got["b"]["std"], got["b"]["min"], got["b"]["nan_pct"]) == (0.0, 0.0, None, 1.0)
    assert got["c"]["max"] == float("inf") and {r["k"]: r for r in aggregates.moments(df, "v", ["k"], True).collect()}["c"]["max"] == 1.0


def test_labels_are_dense_and_stable(spark):
    df = spark.createDataFrame([("b", 3), ("a", 5), ("b", 9), (None, 1), ("c", 4)], "v string, o int")
    first = aggregates.dense_labels(df, "v", "o")
    assert rows(first) == [("a", 2), ("b", 0), ("c", 1)]
    more = df.union(spark.createDataFrame([("z", 0), ("y", 7)], "v string, o int"))
    assert rows(aggregates.dense_labels(more, "v", "o", first)) == [("a", 2), ("b", 0), ("c", 1), ("y", 4), ("z", 3)]


def test_unpivot_and_pivot_are_inverse(spark):
    w = spark.createDataFrame([("x", 1.0, None), ("y", float("nan"), 4.0)], "c string, agri_1999 double, agri_2000 double")
    long = reshape.unpivot_periods(w, ["c"])
    assert rows(long.select("c", "year", "value")) == [("x", 1999, 1.0), ("y", 2000, 4.0)]
    assert rows(reshape.pivot_first(long, ["c"], "year", [1999, 2000], "value", ["year"], "agri_")) == [("x", 1.0, None), ("y", None, 4.0)]
    assert [reshape.parse_header(h) for h in ("NDVI_13/2019", "x", "A_b_2000")] == [None, None, ("A_b", None, 2000)]


def test_windows_and_pad(spark):
    df = spark.createDataFrame([(t, c) for t in (1, 2, 4) for c in (0, 1)], "time int, c int")
    assert rows(batch.windows(df, "time").groupBy("window_start", "t").count()) == [(1, 0, 2), (1, 1, 2), (2, 0, 2), (2, 1, 2)]
    g = spark.createDataFrame([(0, i, j, 1.0) for i in range(3) for j in range(4)], "b int, i int, j int, v double")
    assert grid.pad_to_multiple(g, "i", "j", 3, 4, 4, "v", ["b"]).count() == 16 and grid.crop_to_multiple(g, "i", "j", 3, 4, 2).count() == 8


# Readers and sinks


def test_readers(spark, tmp_path):
    (tmp_path / "wb.csv").write_text('﻿"Data Source","X"\n\nUpdated\n"Country Name","Country Code","Indicator Name","Indicator Code","1999","2000",\n"A, B","AB","i","c","1.5","",\n"C","CC","i","c","..","2",\n')
    assert rows(readers.csv_with_preamble(spark, str(tmp_path / "wb.csv")).select("name", "year", "value")) == sorted([("A, B", 1999, 1.5), ("A, B", 2000, None), ("C", 1999, None), ("C", 2000, 2.0)], key=repr)
    (tmp_path / "occ.tsv").write_text("\t".join(f"f{i}" for i in range(165)) + "\nshort\tline\n")
    assert rows(readers.positional_tsv(spark, str(tmp_path / "occ.tsv"), {"a": 0, "b": 164, "c": 200})) == [("f0", "f164", None)]
    for n, key in (("1.zip", "5"), ("2.zip", "5")):
        with zipfile.ZipFile(tmp_path / n, "w") as z:
            z.writestr("cube.tsv", f"SpeciesKey\tyearmonthday\teeacellcode\n{key}\t2020\tE{n[0]}N1\nbad\tline\ttoo\tmany\n")
    z = readers.zipped_tsv(spark, str(tmp_path), ["specieskey", "eeacellcode", "absent"])
    assert z.count() == 2 and rows(readers.latest_by_key(z, "specieskey").select("eeacellcode", "absent")) == [("E2N1", None)]
    (tmp_path / "names.txt").write_text("a/b/Puma\nPuma\n\n")
    assert rows(readers.names_from_paths(spark, str(tmp_path / "names.txt"))) == [("Puma",)]
    (tmp_path / "l1.csv").write_bytes("Country,v\nCôte,1\n".encode("iso-8859-1"))
    assert readers.csv(spark, str(tmp_path / "l1.csv"), encoding="ISO-8859-1").first()["Country"] == "Côte"


def test_json_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"images": [{"file_name": "f", "id": 1, "width": 2, "height": 3}, {"file_name": "g", "id": 2}], "annotations": [{"image_id": 1, "category_id": 9}, {"image_id": 1, "category_id": 8}], "categories": [{"id": 9, "genus": "G"}]}))
    r = readers.annotations(spark, str(tmp_path / "a.json")).collect()
    assert len(r) == 1 and (r[0]["genus"], r[0]["family"], r[0]["dimensions"]) == ("G", "Unknown", "2x3")
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"properties": {"name": "P"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}}, {"properties": {"name": "M"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[5, 5], [6, 5], [6, 6]]]]}}]}))
    p = readers.polygons(spark, str(tmp_path / "g.json"))
    assert {r["name"]: len(r["ring"]) for r in p.collect()} == {"P": 5, "M": 3}
    assert joins.polygon_cells(p.filter("name = 'P'"), ["name"], "ring", 0.5).count() == 16
    o = spark.createDataFrame([(json.dumps({"id": 7, "photos": [{"url": "https://x/square.jpg"}, {"url": "http://x"}], "geojson": {"coordinates": [3, 4]}, "identifications": [{"taxon": {"ancestors": [{"rank": "genus", "name": "G"}]}}]}),), ("nope",)], "payload string")
    assert [(r["genus"], r["family"], r["latitude"], r["photo_url"]) for r in readers.observations(o).collect()] == [("G", "Unknown", 4.0, "https://x/medium.jpg")]
    dna = spark.createDataFrame([(json.dumps({"record_id": "r", "sequences": {"sequence": [{"nucleotides": "ACGT"}]}}),)], "payload string")
    assert readers.dna_records(dna).first()["nucleotides"] == "ACGT"
    rec = spark.createDataFrame([("A", [""]), ("B", ["x"]), ("D", []), ("A", None)], "q string, also array<string>")
    assert readers.good_recordings(rec).count() == 2


def test_sinks_are_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "i int, s string")
    for _ in range(2):
        sinks.append_new(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    w = spark.createDataFrame([("2020-01-01", 1), ("2020-01-02", 2)], "window_start string, v int")
    for _ in range(2):
        sinks.write_new_windows(w, str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w")).count() == 2
    sinks.write_wide(spark.createDataFrame([("x", 2000, 0.0), ("x", 2001, 1.23456)], "c string, y int, v double"), str(tmp_path / "c"), ["c"], "y", [2000, 2001, 2002], "v")
    assert rows(spark.read.option("header", "true").csv(str(tmp_path / "c"))) == [("x", "0.0", "1.2346", None)]
    sinks.write_json(spark.createDataFrame([(1, None)], "a int, b int"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()["value"] == '{"a":1,"b":null}'
    assert [str(r[0]) for r in sinks.sorted_times(spark.createDataFrame([("['2020-01-02 00:00:00']",), ("x",), ("2020-01-01",), (None,)], "t string"), "t").collect()] == ["2020-01-01 00:00:00", "2020-01-02 00:00:00"]


def test_catalog(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for n in ("a.nc", "x/b.nc", "x/species.parquet"):
        (tmp_path / n).write_bytes(b"1")
    assert rows(catalog.discover(spark, str(tmp_path), {"era5": "*.nc", "species": "*.parquet"}).groupBy("modality").count()) == [("era5", 2), ("species", 1)]
    f = spark.createDataFrame([("r/p/1.jpg",), ("r/p/x_edna.csv",), ("r/q/1.WAV",), ("r/q/readme",)], "path string")
    assert rows(catalog.folder_modalities(f, "path")) == sorted([("r/p", ["edna", "image"]), ("r/q", ["audio"])], key=repr)


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i % 40, f"2024-01-{1 + i % 5:02d} 0{i % 10}:30:00", 40 + i % 40 / 10, 5.1) for i in range(100)], "id int, ts string, lat double, lon double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):
        observations.append(observations.prepared(stream, "ts", "lat", "lon", ["id", "ts"]), out, str(tmp_path / "cp")).awaitTermination()
    want = observations.prepared(df, "ts", "lat", "lon", ["id", "ts"])
    assert rows(spark.read.parquet(out).select("unique_id", "slot", "cell_lat")) == rows(want.select("unique_id", "slot", "cell_lat"))


# Media


def test_audio():
    t = np.arange(8000) / 8000
    x = np.sin(2 * np.pi * 1000 * t)
    s = media.spectrogram(x)
    assert abs(int(s.mean(1).argmax()) - 64) <= 1
    assert np.allclose(media.resample(media.resample(x, 8000, 16000), 16000, 8000), x, atol=1e-6)
    assert media.mfcc(x, 8000).shape[0] == 13 and media.log_mel(x, 8000).shape[0] == 40
    quiet = np.concatenate([x, np.zeros(8192)])
    assert len(media.without_silence(quiet)) < len(quiet) * 0.6 and len(media.without_silence(np.zeros(10))) == 10
    call = np.where((t > 0.3) & (t < 0.5), x, 0.0)
    noisy = call + np.random.default_rng(0).normal(0, 0.05, len(x))
    assert np.std(media.noise_gated(noisy)[600:-600] - call[600:-600]) < np.std(noisy - call)
    b = io.BytesIO()
    with wave.open(b, "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes((np.stack([x, -x], 1) * 32767).astype("<i2").tobytes())
    y, rate = media.read_wav(b.getvalue())
    assert rate == 8000 and y.shape == (2, 8000) and np.allclose(y[0], x, atol=1e-3)
    assert media.fit(x, 9000).shape == (9000,) and media.fit(x, 10).shape == (10,)


def test_images(spark):
    step = np.zeros((16, 16))
    step[:, 8:] = 255
    assert media.edges(step)[:, 7:9].min() > 0 and media.edges(step)[:, :6].max() == 0
    assert np.allclose(media.blurred(np.full((9, 9), 3.0)), 3.0) and media.resized(np.dstack([step] * 3), 4, 6).shape == (4, 6, 3)
    assert np.allclose(media.denormalised(media.normalised(step)), step) and media.centre_cropped(step, 4, 20).shape == (4, 16)
    h = media.hog(step)
    assert h.shape == (2 * 2 * 9,) and np.isfinite(h).all()
    e = media.equalised(np.arange(100, 110).reshape(2, 5))
    assert e.min() == 0 and e.max() == 255
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "v array<double>")
    assert [r["x"] for r in df.select(media.applied(lambda a: a * 2)("v").alias("x")).collect()] == [[2.0, 4.0], None]
