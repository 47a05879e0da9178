"""The driver contract and every registered query against its DuckDB twin at the smallest scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from wayfold.queries.catalog import TABLES

SF = os.environ.get("WAYFOLD_TEST_SF", "/root/testdata/sf0.001")
# oracle-checked sample across the families; tools/check.py runs all of them at any scale
SAMPLE = ["r02_ground_rasters", "r10_slope", "r20_seeded_components", "p03_camera_chain", "p09_pixel_to_ground", "p25_capped_sample", "e08_convex_hull", "e12_line_samples",
          "e15_cell_set_overlap", "e18_fill_small_holes", "j02_nearest_vertex", "j17_closest_frame", "a03_banding", "a21_rank_auc", "a25_similarity_fit", "w06_peak_clusters", "w10_drift_stop",
          "k04_nms", "k05_ensemble_merge", "g02_candidate_clusters", "g04_running_centroids_g16_bucket_snap", "g06_dbscan", "g11_boundary_refine_g12_parts_g13_stats", "g14_snapped_junctions",
          "v11_final_fail_reason", "x24_hybrid_choice", "x41_seed_collection", "s13_frame_parts", "t04_stream_sessions", "t05_stream_drift_state"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "road_cover" in df.columns


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 250


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=str)
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(norm(row[names.index(c)]) for c in cols) for row in res.fetchall()), key=str)
    assert got == want
