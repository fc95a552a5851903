import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import array_of
from stackweave.functions.halos import baseline_halo, normalize_halo, wavelet_halo
from stackweave.model import check_form, densify, to_frames, to_pixels
from stackweave.operators import elementwise, normalize, projections
from stackweave.operators.traces import dense_series, dff, roi_traces, rolling_baseline, wavelet_1d


def image(df, h, w):
    out = np.full((h, w), np.nan)
    for r in df.collect():
        out[r["y"], r["x"]] = r["value"]
    return out


def test_forms_convert_both_ways(frames_of, rng):
    stack = rng.normal(size=(5, 3, 4))
    frames = frames_of(stack)
    np.testing.assert_allclose(array_of(to_frames(to_pixels(frames), (3, 4))), stack)
    with pytest.raises(ValueError):
        check_form(frames.drop("px"), ("t", "px"))


def test_sparse_pixels_become_dense(spark):
    rows = spark.createDataFrame([(2, 0, 1, 5.0), (4, 1, 0, 7.0)], "t long, y int, x int, v double")
    dense = densify(rows, (2, 2), fill=-1.0)
    assert dense.count() == 3 * 4 and dense.agg(F.sum("v")).first()[0] == 12.0 - 10
    assert array_of(to_frames(rows, (2, 2), fill=None)).shape == (2, 2, 2)


def test_normalisation_matches_numpy(frames_of, rng):
    stack = rng.normal(size=(6, 3, 5))
    stack[2] = 0
    flat = stack.reshape(6, -1)
    for order in (0, 1, 2, 3, np.inf, -np.inf):
        n = np.linalg.norm(flat, ord=order, axis=1)[:, None, None]
        want = np.where(n != 0, stack / np.where(n != 0, n, 1), stack)
        np.testing.assert_allclose(array_of(normalize.renormalize(frames_of(stack), order)), want, atol=1e-12)
    centred = array_of(normalize.zeroed_mean(frames_of(stack)))
    np.testing.assert_allclose(centred, stack - stack.mean(axis=(1, 2), keepdims=True), atol=1e-12)


def test_projections_match_numpy(frames_of, rng):
    stack = rng.normal(size=(9, 3, 4))
    frames = frames_of(stack)
    low = stack.min() - 1
    hmean = 1 / (1 / (stack - low)).mean(axis=0) + low
    np.testing.assert_allclose(image(projections.proj_hmean(frames), 3, 4), hmean)
    assert (hmean <= stack.mean(axis=0) + 1e-12).all()
    moments = projections.proj_moments(frames, 3)
    for k, want in enumerate((np.ones((3, 4)), stack.mean(axis=0), (stack**2).mean(axis=0))):
        np.testing.assert_allclose(image(moments.where(F.col("order") == k), 3, 4), want)
    both = array_of(projections.background_subtract(frames))
    np.testing.assert_allclose(both, (stack - hmean) - (stack - hmean).min(), atol=1e-12)
    pixel = projections.background_subtract(to_pixels(frames))
    np.testing.assert_allclose(array_of(to_frames(pixel, (3, 4))), both, atol=1e-12)


@pytest.mark.parametrize("dtype,bounds", [("uint8", (0, 255)), ("int16", (-32768, 32767)), ("float32", (0.0, 1.0))])
def test_rescale_stays_in_bounds(frames_of, rng, dtype, bounds):
    out = array_of(elementwise.norm_layer(frames_of(rng.normal(size=(4, 3, 3)) * 50), dtype))
    assert out.min() == bounds[0] and out.max() == bounds[1]


def test_rescale_of_odd_values(frames_of):
    constant = np.full((2, 2, 2), 3.0)
    assert (array_of(elementwise.norm_layer(frames_of(constant), "uint8")) == 0).all()
    assert np.isnan(array_of(elementwise.norm_layer(frames_of(constant), "float64"))).all()
    odd = np.array([[[np.inf, 1.0], [2.0, 3.0]]])
    with np.errstate(invalid="ignore"):
        want = np.nan_to_num((odd - 1.0) * (255.0 / np.inf))
    np.testing.assert_array_equal(array_of(elementwise.norm_layer(frames_of(odd), "uint8")), want)
    with pytest.raises(ValueError):
        elementwise.norm_layer(frames_of(odd), "text")


def test_traces_of_full_mask_are_frame_means(spark, frames_of, rng):
    stack = rng.normal(size=(5, 3, 4))
    mask = spark.createDataFrame([(1, y, x, 1.0) for y in range(3) for x in range(4)], "roi_id int, y int, x int, w double")
    rois = spark.createDataFrame([(1,), (9,)], "roi_id int")
    rows = roi_traces(frames_of(stack), mask, rois).orderBy("roi_id", "t").collect()
    np.testing.assert_allclose([r["value"] for r in rows[:5]], stack.mean(axis=(1, 2)))
    assert [r["value"] for r in rows[5:]] == [None] * 5


@pytest.mark.parametrize("block", [3, 10, 1000])
def test_series_windows_do_not_depend_on_blocks(spark, rng, block):
    values = rng.normal(size=40).round(3)
    rows = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(values)], "roi_id int, t long, value double")
    got = [r["f0"] for r in rolling_baseline(rows, 4, 0.3, ["roi_id"], block=block).orderBy("t").collect()]
    want = [np.quantile(values[max(0, t - 4):t + 5], 0.3) for t in range(40)]
    np.testing.assert_allclose(got, want)
    rel = [r["dff"] for r in dff(rows, 4, 0.3, ["roi_id"], block=block).orderBy("t").collect()]
    lifted = values + 1 - values.min()
    base = np.array(want) + 1 - values.min()
    np.testing.assert_allclose(rel, (lifted - base) / base)
    parts = wavelet_1d(rows, 3, block=block).groupBy("t").agg(F.sum("value").alias("value")).orderBy("t").collect()
    np.testing.assert_allclose([r["value"] for r in parts], values, atol=1e-12)


def test_wavelet_blocks_agree(spark, rng):
    rows = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(rng.normal(size=50))], "roi_id int, t long, value double")
    tables = [wavelet_1d(rows, 3, block=b).orderBy("level", "t").collect() for b in (5, 1000)]
    np.testing.assert_allclose([r["value"] for r in tables[0]], [r["value"] for r in tables[1]], atol=1e-12)


def test_series_become_dense(spark):
    rows = spark.createDataFrame([(1, 0, 1.0), (1, 3, 2.0), (2, 1, 5.0)], "roi_id int, t long, value double")
    assert dense_series(rows).count() == 8


def test_halo_sizes():
    assert baseline_halo(50, 5.0, 5.0, 5.0, 5.0) == (50, 25, 25)
    assert baseline_halo(10, 5.0, 5.0, 1.1, 2.0, chained=True) == (35, 3, 3)
    assert wavelet_halo(5) == (62, 62, 62) and wavelet_halo((0, 1, 2)) == (0, 2, 6)
    assert normalize_halo() == (0, 0, 0)


def test_empty_stack(frames_of):
    empty = frames_of(np.zeros((0, 2, 2)))
    assert elementwise.trim_frames(empty, 1, 1).count() == 0
    assert projections.projections(empty).count() == 0
    assert projections.background_subtract(empty).count() == 0
    assert projections.stack_bounds(empty).first()["v_min"] is None


def test_one_pixel_stack(frames_of):
    one = frames_of(np.array([[[2.0]]]))
    assert array_of(normalize.normalize_data(one)).tolist() == [[[0.0]]]
    assert image(projections.proj_std(one), 1, 1).tolist() == [[0.0]]


def test_hot_tiles_are_split_by_time(spark, frames_of, rng, monkeypatch):
    """Thousands of regions on one pixel meet the frames in as many keys as there are time blocks, with the same traces."""
    from stackweave.operators import traces

    stack = rng.random((40, 3, 4))
    rois = spark.range(1, 3001).selectExpr("cast(id as int) roi_id", "1 y", "2 x", "cast(id as double) w").unionByName(
        spark.createDataFrame([(1, 0, 0, 2.0), (9000, 2, 3, 0.5)], "roi_id int, y int, x int, w double"))
    frames = frames_of(stack, first=-7)
    plain = {(r[0], r[1]): r[2] for r in traces.roi_traces(frames, rois).collect()}
    monkeypatch.setattr(traces, "TIME_BLOCK", 4)
    monkeypatch.setattr(traces, "TILE", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        split = traces.roi_traces(frames, rois)
        assert {(r[0], r[1]): r[2] for r in split.collect()} == plain
        plan = split._jdf.queryExecution().toString()
        assert "hashpartitioning(fw" in plan and "tb" in plan.split("hashpartitioning(fw")[1][:60]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert plain[(1, -7)] == pytest.approx((stack[0, 1, 2] * 1 + stack[0, 0, 0] * 2) / 3) and len(plain) == 40 * 3001
