import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import array_of
from stackweave.functions.kernels import flood, gaussian_taps, spline_taps, spread_labels, weighted_shift_sum
from stackweave.operators import blocks, filters


def box3(stack):
    """Mean of the 3 x 3 x 3 neighbourhood inside the array."""
    wide = np.pad(stack, 1, constant_values=np.nan)
    views = np.lib.stride_tricks.sliding_window_view(wide, (3, 3, 3))
    return np.nanmean(views, axis=(3, 4, 5))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(block=st.tuples(st.integers(1, 9), st.integers(1, 7), st.integers(1, 8)))
def test_halo_result_does_not_depend_on_blocks(frames_of, block):
    stack = np.random.default_rng(1).normal(size=(8, 6, 7))
    pieces = blocks.map_blocks(frames_of(stack), box3, block, (1, 1, 1))
    np.testing.assert_allclose(array_of(blocks.pieces_to_frames(pieces)), box3(stack))


def test_block_arguments(frames_of, rng):
    stack = rng.normal(size=(4, 4, 4))
    operator = blocks.blockwise(lambda shape: (shape[0], 2, 2))(lambda a: a * 2)
    np.testing.assert_allclose(array_of(blocks.pieces_to_frames(operator(frames_of(stack)))), stack * 2)
    assert blocks.stack_shape(frames_of(stack)) == (4, 4, 4)
    with pytest.raises(ValueError):
        blocks.map_blocks(frames_of(stack), box3, (1, 2))
    with pytest.raises(Exception, match="changed the shape"):
        blocks.map_blocks(frames_of(stack), lambda a: a[:1, :1], (4, 4, 4)).count()


@pytest.mark.parametrize("size", [2, 3, 4])
def test_median_matches_sorting(frames_of, rng, size):
    stack = rng.normal(size=(3, 5, 6))
    wide = np.pad(stack, ((0, 0), (size // 2, size - 1 - size // 2), (size // 2, size - 1 - size // 2)), mode="symmetric")
    want = np.empty_like(stack)
    for t, y, x in np.ndindex(*stack.shape):
        want[t, y, x] = sorted(wide[t, y:y + size, x:x + size].ravel())[size * size // 2]
    np.testing.assert_allclose(array_of(filters.median_filter(frames_of(stack), size)), want)
    clean = array_of(filters.denoise(frames_of(stack), size))
    assert clean.min() == pytest.approx(stack.min())


def test_wavelet_adds_up(frames_of, rng):
    stack = rng.normal(size=(12, 9, 8))
    for scale in (2, (0, 2, 2), (1, 0, 2)):
        top = scale if isinstance(scale, int) else max(scale)
        parts = [array_of(filters.wavelet_transform(frames_of(stack), scale, level)) for level in range(1, top + 2)]
        np.testing.assert_allclose(sum(parts), stack, atol=1e-12)


@pytest.mark.parametrize("block", [(3, 4, 5), (50, 50, 50)])
def test_wavelet_and_baseline_do_not_depend_on_blocks(frames_of, rng, block):
    stack = rng.uniform(1, 2, size=(20, 9, 8))
    whole = array_of(filters.wavelet_transform(frames_of(stack), 2, block=(50, 50, 50)))
    np.testing.assert_allclose(array_of(filters.wavelet_transform(frames_of(stack), 2, block=block)), whole, atol=1e-12)
    args = dict(half_window=3, quantile=0.4, t_sigma=1.0, t_window=2.0, s_sigma=1.0, s_window=1.5)
    # Brute force over the whole array.
    lifted = stack + 1 - stack.min()
    taps, space = gaussian_taps(1.0, 2.0), gaussian_taps(1.0, 1.5)
    smooth = weighted_shift_sum(lifted, 0, taps)
    base = np.array([np.quantile(smooth[max(0, t - 3):t + 4], 0.4, axis=0) for t in range(20)])
    base = weighted_shift_sum(weighted_shift_sum(base, 1, space), 2, space)
    np.testing.assert_allclose(array_of(filters.extract_f0(frames_of(stack), block=block, **args)), (lifted - base) / base, atol=1e-9)
    np.testing.assert_allclose(array_of(filters.extract_f0(frames_of(stack), block=block, return_f0=True, **args)), base, atol=1e-9)
    with pytest.raises(TypeError):
        filters.extract_f0(frames_of(stack), out=1, **args)


def test_taps():
    assert sum(gaussian_taps(1.5, 2.0).values()) == pytest.approx(1) and gaussian_taps(0, 3.0) == {0: 1.0}
    assert sorted(spline_taps(2)) == [-4, -2, 0, 2, 4] and sum(spline_taps(3).values()) == 1
    long = np.arange(3.0)[:, None, None]
    np.testing.assert_allclose(weighted_shift_sum(long, 0, {-2: 1.0})[:, 0, 0], [1, 0, 0])


def test_labels_and_flood(rng):
    mask = rng.random((12, 14)) < 0.45
    labels = spread_labels(mask)
    want = np.zeros(mask.shape, dtype=int)
    for y, x in zip(*np.nonzero(mask)):
        if want[y, x]:
            continue
        todo, first = [(y, x)], y * 14 + x + 1
        while todo:
            cy, cx = todo.pop()
            if 0 <= cy < 12 and 0 <= cx < 14 and mask[cy, cx] and not want[cy, cx]:
                want[cy, cx] = first
                todo += [(cy + a, cx + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    np.testing.assert_array_equal(labels, want)
    row = np.ones((1, 7), dtype=int)
    seeds = np.array([[1, 0, 0, 0, 0, 0, 2]])
    np.testing.assert_array_equal(flood(row, seeds), [[1, 1, 1, 1, 2, 2, 2]])


@pytest.mark.parametrize("tile", [1, 7, 4096])
def test_traces_do_not_depend_on_the_tile(spark, frames_of, rng, monkeypatch, tile):
    """Masks that leave the frame count with their whole weight but meet only what is there."""
    from stackweave.operators import traces

    monkeypatch.setattr(traces, "TILE", tile)
    stack = rng.normal(size=(6, 4, 5))
    masks = [(1, 0, 0, 1.0), (1, 3, 4, 2.0), (2, 1, 2, 0.5), (2, 9, 9, 1.5), (2, 1, 7, 1.0), (3, 8, 8, 1.0)]
    found = traces.roi_traces(frames_of(stack), spark.createDataFrame(masks, "roi_id int, y int, x int, w double"))
    got = {(r["roi_id"], r["t"]): r["value"] for r in found.collect()}
    want = {(1, t): (f[0, 0] + 2 * f[3, 4]) / 3 for t, f in enumerate(stack)} | {(2, t): 0.5 * f[1, 2] / 3 for t, f in enumerate(stack)}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("shape,halo", [((10**6, 64, 64), (62, 0, 0)), ((10**6, 4096, 4096), (62, 3, 3)), ((10, 9000, 9000), (0, 62, 62)), ((0, 0, 0), (1, 1, 1))])
def test_blocks_fit_their_bytes(shape, halo):
    bt, by, bx = blocks.fitting_block(shape, halo)
    held = 8 * (bt + 2 * halo[0]) * (min(by + 2 * halo[1], shape[1])) * (min(bx + 2 * halo[2], shape[2]))
    assert held <= 2 * blocks.BLOCK_BYTES and bt >= 2 * halo[0] and min(by, bx) >= 1


def test_whole_frame_blocks_shuffle_once(frames_of, rng):
    frames = frames_of(rng.normal(size=(9, 4, 5)))
    made = filters.wavelet_transform(frames, (1, 1, 1))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def halved_sum(a, b):
    return (a + 2 * b) / 2


def spread(stack):
    """Sum of a 3 x 3 x 3 neighbourhood of a block that has its whole halo."""
    views = np.lib.stride_tricks.sliding_window_view(stack, (3, 3, 3))
    return np.pad(views.sum(axis=(3, 4, 5)), 1)


@pytest.mark.parametrize("border,mode", [("mirror", {"mode": "symmetric"}), ("edge", {"mode": "edge"}), ("constant", {"constant_values": 4.0})])
@pytest.mark.parametrize("block", [(3, 2, 4), (50, 50, 50), (1, 7, 1)])
def test_borders_equal_padding_of_the_whole(frames_of, rng, border, mode, block):
    stack = rng.random((7, 5, 6))
    got = blocks.pieces_to_frames(blocks.map_stacks([frames_of(stack)], spread, block, (1, 1, 1), border, value=4.0))
    want = np.lib.stride_tricks.sliding_window_view(np.pad(stack, 1, **mode), (3, 3, 3)).sum(axis=(3, 4, 5))
    np.testing.assert_allclose(array_of(got), want)


def test_several_stacks_in_blocks(spark, frames_of, rng):
    a, b = rng.random((9, 4, 5)), rng.random((9, 4, 5))
    got = blocks.pieces_to_frames(blocks.map_stacks([frames_of(a), frames_of(b)], halved_sum, (4, 3, 2), (1, 1, 0)))
    np.testing.assert_allclose(array_of(got), (a + 2 * b) / 2)
    with pytest.raises(ValueError, match="different shapes"):
        blocks.map_stacks([frames_of(a), frames_of(b[:5])], halved_sum, (4, 3, 2))
    with pytest.raises(ValueError, match="borders"):
        blocks.map_stacks([frames_of(a)], spread, (4, 3, 2), border="wrap")
    holes = frames_of(b).where("t <> 3")
    with pytest.raises(Exception, match="missing"):
        blocks.map_stacks([frames_of(a), holes], halved_sum, (4, 3, 2)).collect()
