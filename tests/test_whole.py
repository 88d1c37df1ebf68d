"""Queries take every row of their tables: small tables of mixed cases against brute force, and the given tables against the SQL without its filter."""

import glob
import hashlib
import os
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession, functions as F

from fieldloom.operators import impute, regular
from fieldloom.plans import problems, reference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def events(spark: SparkSession, path, each) -> str:
    """A data folder with the events (event_id, user_id, event_type)."""
    start = datetime(2024, 1, 1)
    spark.createDataFrame([(i, start + timedelta(hours=i % 700), u, t, float(i % 10)) for i, u, t in each], EVENTS).write.parquet(f"{path}/events.parquet")
    return str(path)


def without(name: str, *cuts: str):
    """Sorted rows of the query's SQL with each of ``cuts`` taken out of it; columns by name."""
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    sql = reference.SQL[name]
    for c in cuts:
        sql = sql.replace(c, "")
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    cursor = con.execute(sql)
    order = sorted(range(len(cursor.description)), key=lambda k: cursor.description[k][0])
    return sorted((tuple(r[k] for k in order) for r in cursor.fetchall()), key=repr)


def whole(spark: SparkSession, name: str):
    df = reference.QUERIES[name](spark, FOLDER)
    return rows(df.select(*sorted(df.columns)))


# Species 1 and 4 have one modality, 2 has two, 3 has three, 6 none; ids of every remainder.
MIXED = [(5, 1, "view"), (22, 1, "view"), (34, 2, "view"), (35, 2, "click"), (3, 3, "error"), (51, 3, "view"), (70, 3, "signup"), (8, 4, "click"), (10, 5, "view"), (11, 5, "click"), (1, 6, None)]


def test_modality_counts_of_all_observations(spark, tmp_path):
    sets = defaultdict(set)
    for _, u, t in MIXED:
        sets[u] |= {t} - {None}
    want = Counter("+".join(sorted(s)) for s in sets.values() if s)
    assert rows(reference.QUERIES["modality_counts"](spark, events(spark, tmp_path, MIXED))) == sorted(want.items(), key=repr)
    assert whole(spark, "modality_counts") == sorted(((n, m) for n, m in without("modality_counts", " WHERE event_id % 17 = 0")), key=repr)


def test_beta_jaccard_of_all_species(spark, tmp_path):
    each = [(i * 53, i % 7, "view") for i in range(60)]
    at = defaultdict(set)
    for i, u, _ in each:
        at[int(34.0 + (i * 37 % 3801) / 100.0 + 0.5)].add(u)
    want = {(a, b): 1 - len(p & q) / len(p | q) for a, p in at.items() for b, q in at.items() if p & q}
    assert 0 < len([v for v in want.values() if 0 < v]) and any(not {0, 3, 6} & s for s in at.values())
    got = {(r["a"], r["b"]): r["jaccard"] for r in reference.QUERIES["beta_jaccard"](spark, events(spark, tmp_path, each)).collect()}
    assert got == pytest.approx(want, abs=1e-6)
    every = lambda found: {(a, b): v for a, b, v in found}
    assert every(whole(spark, "beta_jaccard")) == pytest.approx(every(without("beta_jaccard", " WHERE species % 3 = 0")), abs=1e-6)


def test_reverse_geocode_of_all_points(spark, tmp_path):
    each = [(i * 11 + 1, i, "view") for i in range(150)]
    folder = events(spark, tmp_path, each)
    nations = [("A", 0), ("B", 1), ("C", 5), ("D", 9), ("E", 16)]
    spark.createDataFrame(nations, "n_name string, n_nationkey int").write.parquet(f"{folder}/nation.parquet")
    mid = [(n, 36.5 + k % 6 * 6, -21.25 + k % 7 * 10) for n, k in nations]
    near = lambda la, lo: min((((la - a) ** 2 + (lo - o) ** 2) ** 0.5, n) for n, a, o in mid)[1]
    want = Counter(near(34.0 + (i * 37 % 3801) / 100.0, -30.0 + (i * 91 % 8001) / 100.0) for i, _, _ in each)
    assert len(want) > 1 and sum(want.values()) == 150
    assert rows(reference.QUERIES["reverse_geocode"](spark, folder)) == sorted(want.items())
    assert whole(spark, "reverse_geocode") == without("reverse_geocode", " WHERE event_id % 7 = 0")


def test_one_hot_of_all_sequences(spark, tmp_path):
    each = [(i, 1, "view") for i in (0, 1, 7, 10, 19, 123, 4560)]
    dna = {i: hashlib.md5(str(i).encode()).hexdigest()[:30].translate(str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT")) for i, _, _ in each}
    want = [(i, "".join("1" if s[k : k + 1] == b else "0" for b in "ACGT" for k in range(32))) for i, s in dna.items()]
    assert rows(reference.QUERIES["one_hot"](spark, events(spark, tmp_path, each))) == sorted(want, key=repr)
    assert whole(spark, "one_hot") == sorted(((c, i) for c, i in without("one_hot", " WHERE event_id % 10 = 0")), key=repr)


def test_ndvi_columns_of_all_months(spark, tmp_path):
    each = [(1.0, 2.0, "01/2018", 0.1), (1.0, 2.0, "01/2018", 0.3), (1.0, 2.0, "12/2018", 0.2), (1.0, 2.0, "02/2019", 0.4), (3.0, 4.0, "06/2031", 0.5), (3.0, 4.0, "07/2018", 255.0), (3.0, 4.0, "02/2019", float("nan")), (5.0, 6.0, "02/2019", -0.1)]
    spark.createDataFrame(each, "latitude double, longitude double, month_year string, ndvi double").write.parquet(f"{tmp_path}/ndvi_grid.parquet")
    df = reference.QUERIES["ndvi_month_columns"](spark, str(tmp_path))
    assert df.columns == ["latitude", "longitude", "NDVI_01/2018", "NDVI_07/2018", "NDVI_12/2018", "NDVI_02/2019", "NDVI_06/2031"]
    assert rows(df) == [(1.0, 2.0, 0.3, None, 0.2, 0.4, None), (3.0, 4.0, None, None, None, None, 0.5), (5.0, 6.0, None, None, None, -0.1, None)]


def test_ndvi_columns_hold_every_month_of_the_given_table(spark):
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    con = duckdb.connect()
    found = con.execute(f"SELECT latitude, longitude, 'NDVI_' || month_year, max(ndvi) FROM '{FOLDER}/ndvi_grid.parquet' WHERE ndvi BETWEEN -0.2 AND 1 AND NOT isnan(ndvi) GROUP BY ALL").fetchall()
    got = [(r["latitude"], r["longitude"], c, r[c]) for r in reference.QUERIES["ndvi_month_columns"](spark, FOLDER).collect() for c in r.asDict() if c[:5] == "NDVI_" and r[c] is not None]
    assert sorted(got, key=repr) == sorted(found, key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_filled_rows_depend_on_the_decoded_value(spark, monkeypatch):
    df = problems.p2_found(spark, FOLDER)
    assert plan(df).count("ArrowEvalPython") == 3 and df.count() > 0
    monkeypatch.setattr(impute, "_decoded", lambda y, spec, size: [float("nan")] * size)
    assert problems.p2_found(spark, FOLDER).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_missing_months_depend_on_the_estimate(spark):
    df = problems.p3_found(spark, FOLDER)
    assert "coef" in plan(df) and "isnan" in plan(df)
    assert rows(df) == rows(problems.p3_series(spark, FOLDER).filter("is_missing").select(*df.columns)) != []


def test_months_without_a_model_are_bridged(spark):
    df = spark.createDataFrame([(1, 24000, 1e308), (1, 24002, 1.5e308), (2, 24000, 1.0), (2, 24001, 1.0)], "s int, m int, v double")
    got = {r["m"]: r["filled"] for r in regular.regular_monthly(df, ["s"], "m", "v", ["s"]).filter("s = 1").collect()}
    assert got == pytest.approx({24000: 1e308, 24001: 1.25e308, 24002: 1.5e308})


def near(found):
    return [tuple(round(v, 5) + 0.0 if isinstance(v, float) else v for v in r) for r in found]


@pytest.mark.parametrize(
    ("name", "cuts", "number"),
    [("zscore", [" WHERE t_idx < 5"], 30720), ("unzscore", [" WHERE t_idx < 5"], 30720), ("crop_truncate", [" AND t_idx = 0"], 27000), ("tensor_export", [" WHERE t_idx < 3"], 120), ("sink_windows", [" WHERE t_idx < 8", " AND t_idx < 8"], 39)],
)
def test_cube_queries_take_all_steps(spark, name, cuts, number):
    got = whole(spark, name)
    assert len(got) == number
    assert sorted(near(got), key=repr) == sorted(near(without(name, *cuts)), key=repr)


def test_crop_pad_of_all_steps(spark):
    value = lambda t, level, a, b: 0.0 if a > 15 or b > 15 else None if (t + a + b) % 29 == 0 else (t * 31 + level * 7 + a * 13 + b * 17) % 997 / 4.0
    want = [(t, level, a, b, value(t, level, a, b)) for t in range(40) for level in (50, 500, 1000) for a in range(20) for b in range(20)]
    df = reference.QUERIES["crop_pad"](spark, FOLDER)
    assert rows(df.select("t_idx", "level", "lat_idx", "lon_idx", "value")) == sorted(want, key=repr)
