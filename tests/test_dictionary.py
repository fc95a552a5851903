import numpy as np
import pytest

from conftest import array_of
from stackweave.functions.coding import lasso_codes, lasso_path, omp_codes
from stackweave.operators import dictionary
from stackweave.sources.store import DatasetStore
from stackweave.streaming import jobs


@pytest.fixture
def mixed(rng):
    """Frames mixed from 4 hidden atoms, two at a time."""
    atoms = rng.normal(size=(4, 30))
    atoms /= np.linalg.norm(atoms, axis=1, keepdims=True)
    codes = np.zeros((60, 4))
    for row in codes:
        row[rng.choice(4, 2, replace=False)] = rng.uniform(1, 2, size=2)
    return (codes @ atoms + rng.normal(0, 0.01, size=(60, 30))).reshape(60, 5, 6)


def test_pursuit_keeps_to_k_and_improves(rng):
    d = rng.normal(size=(10, 20))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    x = rng.normal(size=(15, 20))
    last = np.full(15, np.inf)
    for k in range(1, 8):
        codes = omp_codes(d @ d.T, x @ d.T, k)
        left = np.linalg.norm(x - codes @ d, axis=1)
        assert ((codes != 0).sum(axis=1) <= k).all() and (left <= last + 1e-9).all()
        last = left
    twice = np.vstack([d[:1], d[:1]])
    np.testing.assert_allclose(omp_codes(twice @ twice.T, x @ twice.T, 2) @ twice, (x @ d[:1].T) @ d[:1], atol=1e-9)


@pytest.mark.parametrize("positive", [False, True])
def test_lasso_meets_its_conditions(rng, positive):
    d = rng.normal(size=(6, 20))
    x = rng.normal(size=(9, 20))
    c = lasso_codes(d @ d.T, x @ d.T, 0.7, 2000, positive, tol=1e-10)
    slope = (x - c @ d) @ d.T
    on = c != 0
    np.testing.assert_allclose(slope[on], 0.7 * np.sign(c[on]), atol=1e-6)
    assert (slope[~on] <= 0.7 + 1e-6).all() and (positive or (slope[~on] >= -0.7 - 1e-6).all())
    assert not positive or (c >= 0).all()


@pytest.mark.parametrize("seed", range(25))
@pytest.mark.parametrize("positive", [False, True])
def test_paths_solve_the_lasso_at_every_knot(seed, positive):
    """Each knot meets the lasso's conditions for its weight, so does the line between two, and descent finds the same codes."""
    rng = np.random.default_rng(seed)
    k, f = rng.integers(1, 9), rng.integers(6, 20)
    d = rng.normal(size=(k, f)) + rng.normal(size=f) * rng.choice([0, 2])
    if seed % 5 == 0 and k > 2:
        d[1], d[2] = d[0], 0
    x = rng.normal(size=f) * 3
    g, cov = d @ d.T, d @ x
    knots = lasso_path(g, cov, 0.05, positive)
    weights = [w for w, _ in knots]
    assert weights == sorted(weights, reverse=True) and weights[-1] == pytest.approx(0.05)
    between = [((a + b) / 2, (c + e) / 2) for (a, c), (b, e) in zip(knots, knots[1:])]
    for w, c in knots + between:
        pull, on = cov - g @ c, np.abs(c) > 1e-11
        np.testing.assert_allclose(pull[on], w * np.sign(c[on]), atol=1e-8)
        assert (pull <= w + 1e-8).all() and (positive or (pull >= -w - 1e-8).all()) and (not positive or (c >= -1e-12).all())
    if seed % 5:
        np.testing.assert_allclose(knots[-1][1], lasso_codes(g, cov[None], 0.05, 100_000, positive, 1e-13)[0], atol=1e-7)


def test_pursuit_stops_at_its_residual(rng):
    d = rng.normal(size=(12, 20))
    x = rng.normal(size=(30, 20))
    squares = (x * x).sum(axis=1)
    codes = omp_codes(d @ d.T, x @ d.T, 12, squares, 6.0)
    left, used = ((x - codes @ d) ** 2).sum(axis=1), (codes != 0).sum(axis=1)
    assert ((left <= 6.0 + 1e-9) | (used == 12)).all() and len(set(used.tolist())) > 2
    for n in set(used.tolist()) - {0}:
        before = omp_codes(d @ d.T, x @ d.T, n - 1)[used == n]
        assert (((x[used == n] - before @ d) ** 2).sum(axis=1) > 6.0).all()
    assert not omp_codes(d @ d.T, x @ d.T, 12, squares, 1e9).any()


def test_paths_and_tolerances_in_tables(spark, frames_of, rng, monkeypatch):
    from stackweave.operators import tiled

    stack = rng.normal(size=(12, 3, 4))
    frames, atoms = frames_of(stack), frames_of(stack[:4], key="atom")
    d, x = stack[:4].reshape(4, -1), stack.reshape(12, -1)

    def run():
        path = sorted((r["t"], r["knot"], r["atom"], round(r["weight"], 8), round(r["coef"], 8)) for r in dictionary.encode_path(frames, atoms, 0.5).collect())
        codes = [sorted((r["t"], r["atom"], round(r["coef"], 6)) for r in dictionary.sparse_encode(frames, atoms, m, alpha=0.5, tol=t).collect())
                 for m, t in (("lars", None), ("lasso", None), ("omp", 4.0))]
        return path, *codes

    whole = run()
    want = [(t, k, j, round(w, 8), round(c[j], 8)) for t in range(12) for k, (w, c) in enumerate(lasso_path(d @ d.T, d @ x[t], 0.5)) for j in np.nonzero(c)[0]]
    assert whole[0] == sorted(want) and whole[1] == whole[2]
    monkeypatch.setattr(tiled, "TILE_VALUES", 12)
    assert run() == whole
    assert dictionary.encode_path(frames, atoms.limit(0)).count() == 0


def test_fit_lowers_the_objective(spark, frames_of, mixed):
    report = []
    learned = dictionary.fit(frames_of(mixed), 4, alpha=0.05, rounds=8, seed=2, report=report)
    assert report[-1] < 0.8 * report[0]
    assert np.linalg.norm(learned.atoms, axis=1).max() <= 1 + 1e-9
    assert dictionary.atoms_frame(spark, learned).count() == 4


def test_fit_continues_from_saved_state(spark, frames_of, mixed):
    frames = frames_of(mixed)
    whole = dictionary.fit(frames, 4, alpha=0.05, rounds=4, seed=2, chunks=2)
    half = dictionary.fit(frames, 4, alpha=0.05, rounds=2, seed=2, chunks=2)
    state = dictionary.state_from_tables(dictionary.state_tables(spark, half))
    again = dictionary.fit(frames, alpha=0.05, rounds=2, state=state, chunks=2)
    np.testing.assert_allclose(again.atoms, whole.atoms, atol=1e-9)
    assert again.rounds == 4


def test_positive_dictionary(frames_of, mixed):
    learned = dictionary.fit(frames_of(np.abs(mixed)), 4, 0.05, 3, positive_code=True, positive_dict=True)
    assert (learned.atoms >= 0).all()


def test_encode_and_reconstruct(spark, frames_of, mixed):
    frames = frames_of(mixed)
    atoms = dictionary.atoms_frame(spark, dictionary.fit(frames, 4, 0.05, 8, seed=2))
    code = dictionary.sparse_encode(frames, atoms, k=4)
    back = np.zeros(mixed.shape)
    for r in dictionary.reconstruct(code, atoms).collect():
        back[r["t"], r["y"], r["x"]] = r["v"]
    d = array_of(atoms, "atom").reshape(4, -1)
    best = np.linalg.lstsq(d.T, mixed.reshape(60, -1).T, rcond=None)[0].T @ d
    np.testing.assert_allclose(back.reshape(60, -1), best, atol=1e-8)
    assert dictionary.sparse_encode(frames, atoms).groupBy("t").count().agg({"count": "max"}).first()[0] <= 3
    assert dictionary.sparse_encode(frames, atoms, "lasso", alpha=1e9).count() == 0
    with pytest.raises(ValueError):
        dictionary.sparse_encode(frames, atoms, "other")


def test_more_atoms_than_frames(frames_of, rng):
    learned = dictionary.fit(frames_of(rng.normal(size=(3, 2, 2))), 10, 0.1, 2)
    assert len(learned.atoms) == 3
    with pytest.raises(ValueError):
        dictionary.fit(frames_of(rng.normal(size=(3, 2, 2))))


@pytest.mark.parametrize("frames,block,k", [(500, 96, 50), (150, 40, 7), (12, 5, 3), (10, 10, 4), (7, 2, 100)])
def test_allocation_is_exact(spark, frames, block, k):
    stack = spark.range(frames).withColumnRenamed("id", "t")
    rows = dictionary.allocate_atoms(stack, block, k).orderBy("tb").collect()
    assert sum(r["k"] for r in rows) == k and sum(r["frames"] for r in rows) == frames
    assert all(abs(r["k"] - k * r["frames"] / frames) < 1 for r in rows)
    at = 0
    for r in rows:
        assert r["k_offset"] == at and (r["k"], at) == dictionary.share_of(r["tb"], frames, block, k)
        at += r["k"]


def test_fit_blocks_fills_every_atom(frames_of, mixed):
    made = array_of(dictionary.fit_blocks(frames_of(mixed), 7, (25, 2, 4), alpha=0.05, rounds=2), "atom")
    assert made.shape == (7, 5, 6) and not np.isnan(made).any()


def test_stream_learns_once_per_batch(spark, frames_of, mixed, tmp_path):
    source = str(tmp_path / "in")
    frames_of(mixed).write.parquet(source)
    store = DatasetStore(spark, str(tmp_path / "store"))
    schema = spark.read.parquet(source).schema

    def run():
        arriving = spark.readStream.schema(schema).parquet(source)
        jobs.stream_fit(arriving, store, str(tmp_path / "check"), 4, 0.05, rounds=2).awaitTermination()
        return jobs.load_state(store)

    first, epoch = run()
    assert (first.rounds, epoch) == (2, 0)
    frames_of(mixed[:10]).write.mode("append").parquet(source)
    second, epoch = run()
    assert (second.rounds, epoch) == (4, 1)
    assert {n.split("/")[1] for n in store} == {"000000001"}


def tiled_case(frames_of, rng):
    stack = rng.normal(size=(70, 5, 6))
    frames = frames_of(stack)
    return frames, dictionary.initial_atoms(frames, 4, 1)


def test_tiles_learn_the_same_dictionary(frames_of, rng, monkeypatch):
    from stackweave.operators import tiled

    frames, init = tiled_case(frames_of, rng)
    whole, parts = [], []
    want = array_of(dictionary.fit_atoms(frames, init, alpha=0.3, rounds=3, report=whole), "atom")
    monkeypatch.setattr(tiled, "TILE_VALUES", 28)
    got = array_of(dictionary.fit_atoms(frames, init, alpha=0.3, rounds=3, report=parts), "atom")
    np.testing.assert_allclose(got, want, atol=1e-6)
    np.testing.assert_allclose(parts, whole, rtol=1e-6)


@pytest.mark.parametrize("options", [
    {"chunks": 3, "positive_dict": True, "positive_code": True}, {"batch": 20, "revive": True, "dead": True},
], ids=lambda o: next(iter(o)))
def test_tiles_know_every_option(frames_of, rng, monkeypatch, options):
    """The same results on both sides of one tile, whatever is asked for."""
    from stackweave.operators import tiled

    stack = np.abs(rng.normal(size=(50, 3, 4))) if "positive_dict" in options else rng.normal(size=(50, 3, 4))
    frames, first = frames_of(stack), stack[:3].copy()
    if options.pop("dead", False):
        first[1] = 0
    init = frames_of(first, key="atom")
    want = array_of(dictionary.fit_atoms(frames, init, alpha=0.3, rounds=4, **options), "atom")
    monkeypatch.setattr(tiled, "TILE_VALUES", 18)
    got = array_of(dictionary.fit_atoms(frames, init, alpha=0.3, rounds=4, **options), "atom")
    np.testing.assert_allclose(got, want, atol=1e-6)
    assert want.any(axis=(1, 2)).all() and not np.allclose(want, first)


def online(x, atoms, alpha, rounds, batch):
    """Mini-batch learning in plain numpy, atom by atom."""
    k, passes = len(atoms), -(-len(x) // batch)
    a, b = np.zeros((k, k)), np.zeros_like(atoms)
    for step in range(rounds):
        some = x[step % passes * batch:][:batch]
        codes = lasso_codes(atoms @ atoms.T, some @ atoms.T, alpha)
        theta = step * batch if step < batch - 1 else batch**2 + step - batch
        beta = max(0, (theta + 1 - batch) / (theta + 1))
        a, b = beta * a + codes.T @ codes, beta * b + codes.T @ some
        for j in range(k):
            if a[j, j] > 1e-12:
                new = atoms[j] + (b[j] - a[j] @ atoms) / a[j, j]
                atoms = np.vstack([atoms[:j], new / max(1, np.linalg.norm(new)), atoms[j + 1:]])
    return atoms


@pytest.mark.parametrize("batch", [1, 7, 40])
def test_mini_batches_follow_the_online_algorithm(frames_of, rng, batch):
    stack = rng.normal(size=(40, 4, 5))
    learned = dictionary.fit(frames_of(stack), alpha=0.2, rounds=7, init=frames_of(stack[:8], key="atom"), batch=batch)
    np.testing.assert_allclose(learned.atoms, online(stack.reshape(40, -1), stack[:8].reshape(8, -1), 0.2, 7, batch), atol=1e-7)


def test_tile_state_resumes_and_streams(spark, frames_of, rng, tmp_path):
    from stackweave.operators import tiled
    from stackweave.session import Scratch

    stack = rng.normal(size=(30, 3, 4))
    frames, init, scratch = frames_of(stack), frames_of(stack[:3], key="atom"), Scratch(spark, "state")
    whole = tiled.learn(frames, tiled.start_state(init, scratch, 5), 0.2, 3, scratch, chunks=2)
    half = tiled.state_from_tables(tiled.state_tables(tiled.learn(frames, tiled.start_state(init, scratch, 5), 0.2, 1, scratch, chunks=2)))
    again = tiled.learn(frames, half, 0.2, 2, scratch, chunks=2)
    np.testing.assert_allclose(array_of(tiled.atoms_of(again), "atom"), array_of(tiled.atoms_of(whole), "atom"), atol=1e-9)
    assert again.rounds == 3 and whole.tiles.count() == 3
    source, store = str(tmp_path / "in"), DatasetStore(spark, str(tmp_path / "store"))
    frames.write.parquet(source)

    def run():
        arriving = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        jobs.stream_fit_tiles(arriving, store, str(tmp_path / "check"), 3, 0.2, rounds=2, seed=1, size=5).awaitTermination()
        return jobs.load_tiles(store)

    state, epoch = run()
    want = dictionary.fit(frames, 3, 0.2, 2, seed=1)
    np.testing.assert_allclose(array_of(tiled.atoms_of(state), "atom").reshape(3, -1), want.atoms, atol=1e-7)
    frames_of(stack[:9] + 1).write.mode("append").parquet(source)
    state, epoch = run()
    assert (state.rounds, epoch) == (4, 1) and {n.split("/")[1] for n in store} == {"000000001"}


def test_large_dictionaries_are_not_collected(frames_of, rng, monkeypatch):
    monkeypatch.setattr(dictionary, "HELD_VALUES", 10)
    with pytest.raises(ValueError, match="fit_atoms"):
        dictionary.fit(frames_of(rng.normal(size=(3, 2, 3))), 2, 0.1, 1)


@pytest.mark.parametrize("method", ["omp", "lasso"])
def test_tiles_code_the_same(frames_of, rng, monkeypatch, method):
    from stackweave.operators import tiled

    frames, init = tiled_case(frames_of, rng)

    def run():
        codes = dictionary.sparse_encode(frames, init, method, k=2, alpha=0.3).collect()
        pairs = dictionary.correlate(frames, init).collect()
        return [sorted((r[0], r[1], round(r[2], 6)) for r in rows) for rows in (codes, pairs, dictionary.gram(init).collect())]

    want = run()
    monkeypatch.setattr(tiled, "TILE_VALUES", 28)
    assert run() == want


def test_too_few_frames_for_the_atoms_of_a_block(frames_of, rng):
    with pytest.raises(Exception, match="fewer atoms"):
        dictionary.fit_blocks(frames_of(rng.normal(size=(4, 2, 2))), 6, (4, 2, 2)).collect()


def test_unused_atoms_come_back_as_frames(frames_of, rng):
    stack = rng.normal(size=(30, 2, 3))
    frames = frames_of(stack)
    init = frames_of(np.concatenate([stack[:1], np.zeros((1, 2, 3))]), key="atom")
    still = dictionary.fit(frames, alpha=0.1, rounds=2, init=init)
    alive = dictionary.fit(frames, alpha=0.1, rounds=2, init=init, revive=True)
    assert not still.atoms[1].any() and alive.atoms[1].any()


def test_blocks_take_positive_atoms_and_own_learners(frames_of, rng):
    frames = frames_of(np.abs(rng.normal(size=(12, 4, 4))))
    made = array_of(dictionary.fit_blocks(frames, 4, (6, 2, 2), 0.1, 2, positive_dict=True), "atom")
    assert made.shape == (4, 4, 4) and (made >= 0).all()
    means = array_of(dictionary.fit_blocks(frames, 2, (6, 4, 4), learner=lambda x, atoms, *_: np.tile(x.mean(axis=0), (len(atoms), 1))), "atom")
    np.testing.assert_allclose(means[0], array_of(frames)[:6].mean(axis=0))


def test_reconstruct_sums_by_frame_and_keeps_the_rules_of_a_join(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "PRODUCT_VALUES", 12)
    atoms = spark.createDataFrame([(1, 2, 2, [1.0, 2.0, 3.0, 4.0]), (2, 2, 2, [10.0, 20.0, None, 40.0]), (2, 2, 2, [0.5, 0.5, 0.5, 0.5]), (None, 2, 2, [9.0] * 4)],
                                  "atom long, h int, w int, px array<double>")
    code = spark.createDataFrame([(1, 0, 2.0), (2, 0, 1.0), (1, 1, 1.0), (1, 1, 1.0), (7, 2, 1.0), (2, 3, -1.0), (1, 4, None), (None, 5, 1.0), (1, None, 3.0)]
                                 + [(1, t, float(t)) for t in range(6, 30)], "atom long, t long, coef double")
    made = dictionary.reconstruct(code, atoms)
    # Pixels appear after the sums: no task holds a sum per pixel.
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate [t")
    got = {(r["t"], r["y"], r["x"]): r["v"] for r in made.collect()}
    want = {0: [12.5, 24.5, 6.5, 48.5], 1: [2.0, 4.0, 6.0, 8.0], 3: [-10.5, -20.5, -0.5, -40.5], 4: [None] * 4, None: [3.0, 6.0, 9.0, 12.0]}
    want |= {t: [t * v for v in (1.0, 2.0, 3.0, 4.0)] for t in range(6, 30)}
    assert got == {(t, k // 2, k % 2): v for t, px in want.items() for k, v in enumerate(px)}
    # Atoms of several shapes are joined pixel by pixel.
    mixed = spark.createDataFrame([(1, 1, 1, [1.0]), (2, 1, 2, [5.0, 7.0])], "atom long, h int, w int, px array<double>")
    rows = dictionary.reconstruct(code.where("t = 0"), mixed).collect()
    assert {(r["x"], r["v"]) for r in rows} == {(0, 7.0), (1, 7.0)}
