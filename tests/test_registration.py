import numpy as np
import pytest

from conftest import array_of
from stackweave.operators import registration
from stackweave.operators.registration import nearest_matches


@pytest.fixture
def scene(rng):
    """Frames of one scene under known shifts, with a little noise."""
    y, x = np.mgrid[:40, :48]
    base = sum(np.exp(-((y - a) ** 2 + (x - b) ** 2) / c) for a, b, c in ((10, 12, 20), (28, 30, 35), (20, 40, 12)))
    moves = rng.integers(-4, 5, size=(30, 2))
    stack = np.array([np.roll(base, tuple(-m), axis=(0, 1)) for m in moves]) + rng.normal(0, 0.02, size=(30, 40, 48))
    return stack, moves


def shifts_of(df):
    return np.array([[r["dy"], r["dx"]] for r in df.orderBy("t").collect()])


def test_finds_known_shifts(frames_of, scene):
    stack, moves = scene
    frames = frames_of(stack)
    template, distances = registration.find_template(frames)
    found = shifts_of(registration.with_offsets(frames, template))
    gap = found - moves
    assert (gap == gap[0]).all()
    assert distances[-1] == 0.0 and len(distances) <= 5
    assert abs(found.mean(axis=0)).max() <= 0.5


def test_as_written_misses_the_shifts(frames_of, scene):
    stack, moves = scene
    found = shifts_of(registration.estimate_shifts(frames_of(stack), as_written=True))
    gap = found - moves
    assert (gap != np.median(gap, axis=0)).any(axis=1).mean() > 0.5


def test_registered_frames_agree(frames_of, rng):
    base = rng.uniform(1, 2, size=(20, 22))
    moves = rng.integers(-2, 3, size=(12, 2))
    stack = np.array([np.roll(base, tuple(-m), axis=(0, 1)) for m in moves])
    images, shifts = registration.register(frames_of(stack))
    made = array_of(images)
    span = shifts_of(shifts).max(axis=0) - shifts_of(shifts).min(axis=0)
    assert made.shape == (12, 20 - span[0], 22 - span[1])
    assert made.std(axis=0).max() < 1e-12


def test_roll_there_and_back(frames_of, rng):
    stack = rng.normal(size=(6, 4, 5))
    from pyspark.sql import functions as F

    moved = frames_of(stack).withColumn("dy", F.expr("cast(t % 7 - 3 as int)")).withColumn("dx", F.expr("cast(2 - t as int)"))
    rolled = registration.roll_frames(moved)
    want = np.array([np.roll(f, (t % 7 - 3, 2 - t), axis=(0, 1)) for t, f in enumerate(stack)])
    np.testing.assert_allclose(array_of(rolled), want)
    back = registration.roll_frames(rolled.withColumn("dy", -F.col("dy")).withColumn("dx", -F.col("dx")))
    np.testing.assert_allclose(array_of(back), stack)


def test_align_keeps_what_all_frames_share(frames_of, rng):
    from pyspark.sql import functions as F

    scene = rng.normal(size=(30, 30))
    at = rng.integers(0, 6, size=(8, 2))
    stack = np.array([scene[a:a + 20, b:b + 20] for a, b in at])
    table = F.array(*[F.array(*[F.lit(int(v)) for v in m]) for m in at])
    moved = frames_of(stack).withColumn("dy", table[F.col("t").cast("int")][0]).withColumn("dx", table[F.col("t").cast("int")][1])
    made = array_of(registration.align(moved))
    assert np.ptp(made, axis=0).max() == 0
    assert np.ptp(array_of(registration.align(moved, as_written=True)), axis=0).max() > 0


def test_match_choice():
    match = np.zeros((4, 5, 6), dtype=bool)
    match[0, 4, 5] = match[0, 2, 0] = True
    match[1, 2, 3] = True
    match[3, 1, 0] = match[3, 0, 1] = True
    np.testing.assert_array_equal(nearest_matches(match), [[-1, -1], [2, 3], [0, 0], [0, 1]])


def test_no_frames(frames_of):
    images, shifts = registration.register(frames_of(np.zeros((0, 3, 3))))
    assert images.count() == 0 and shifts.count() == 0


def test_one_frame(frames_of, rng):
    stack = rng.normal(size=(1, 5, 5))
    images, shifts = registration.register(frames_of(stack))
    np.testing.assert_allclose(array_of(images), stack)
