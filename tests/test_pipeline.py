import numpy as np
import pytest

from stackweave.plans.pipeline import PipelineParams, run_pipeline, stack_of
from stackweave.operators.registration import register
from stackweave.sources.store import DatasetStore
from stackweave.operators.traces import roi_traces

# Frame size, centres, radii and magnitudes of the discs, and the groups active together.
SHAPE = (110, 120)
DISCS = [(30, 24, 6, 15), (59, 65, 6, 16), (21, 65, 6, 15), (80, 78, 6, 17), (72, 16, 7, 16), (45, 32, 6, 16)]
GROUPS = [(1, 3, 4), (0, 2), (5,)]
BORDER, BORDER_VALUE, STEPS = 5, 50000, 25


def disc_stack():
    """Three groups of discs, each lit up and down once, and the ramps that light them."""
    y, x = np.mgrid[:SHAPE[0], :SHAPE[1]]
    discs = []
    for cy, cx, r, gain in DISCS:
        d2 = (y - cy) ** 2 + (x - cx) ** 2
        discs.append(np.where(d2 <= r * r, gain * np.exp(-d2 / (2 * (r / 3) ** 2)), 0))
    ramp = np.concatenate([np.linspace(0, 1, STEPS), np.linspace(1, 0, STEPS)])
    ramps = np.zeros((len(GROUPS), len(GROUPS) * len(ramp)))
    for g in range(len(GROUPS)):
        ramps[g, g * len(ramp):(g + 1) * len(ramp)] = ramp
    bases = np.array([np.max([discs[i] for i in group], axis=0) for group in GROUPS])
    stack = np.tensordot(ramps.T, bases, axes=1)
    stack = np.floor(stack * 65535 / stack.max())
    return stack, discs, ramps


def test_true_masks_follow_the_ramps(spark, frames_of):
    stack, discs, ramps = disc_stack()
    cells = [(i + 1, int(y), int(x), 1.0) for i, d in enumerate(discs) for y, x in zip(*np.nonzero(d))]
    masks = spark.createDataFrame(cells, "roi_id int, y int, x int, w double")
    got = roi_traces(frames_of(stack), masks).orderBy("roi_id", "t").toPandas()
    for g, group in enumerate(GROUPS):
        for i in group:
            trace = got[got.roi_id == i + 1].value.to_numpy()
            assert np.corrcoef(trace, ramps[g])[0, 1] > 0.9999


# Without the border the frames have nothing in common to be registered by.
@pytest.mark.parametrize("border,rounds", [(False, 0), (True, 5)])
def test_whole_workflow_recovers_the_discs(spark, frames_of, tmp_path, border, rounds):
    stack, _, ramps = disc_stack()
    if border:
        stack[:, :BORDER] = stack[:, -BORDER:] = BORDER_VALUE
        stack[:, :, :BORDER] = stack[:, :, -BORDER:] = BORDER_VALUE
    store = DatasetStore(spark, str(tmp_path / "store"))
    run_pipeline(store, frames_of(stack), PipelineParams(register_rounds=rounds, n_atoms=10, fit_rounds=5, code_atoms=3))
    for name in ("raw", "trim", "dn", "reg/images", "reg/shifts", "proj/hmean", "proj/max", "proj/mean", "proj/std", "sub", "norm",
                 "dict_init_data", "dict_init_dict", "dict", "code", "post/pixels", "post/rois", "rois/masks", "rois/labels", "traces"):
        assert name in store, name
    assert store["trim"].count() == 148 and stack_of(store, "sub").agg({"v": "min"}).first()[0] == 0
    rois = store["post/rois"].toPandas()
    shifts = store["reg/shifts"].toPandas()
    offset = np.array([shifts.dy.max(), shifts.dx.max()])
    traces = store["traces"].toPandas()
    for g, group in enumerate(GROUPS):
        for i in group:
            cy, cx = np.array(DISCS[i][:2]) - offset
            near = rois[(rois.cy - cy) ** 2 + (rois.cx - cx) ** 2 < 9]
            assert len(near) >= 1, (i, rois[["cy", "cx"]])
            trace = traces[traces.roi_id == near.roi_id.iloc[0]].sort_values("t").value.to_numpy()
            assert np.corrcoef(trace, ramps[g][1:-1])[0, 1] > 0.95


def test_registration_leaves_still_frames_alone(frames_of):
    stack, _, _ = disc_stack()
    _, shifts = register(frames_of(stack[20:30]))
    assert shifts.where("dy <> 0 OR dx <> 0").count() == 0
