"""The whole workflow: every stage reads the stored result of the one before and stores its own."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.model import as_type_of, promote, to_pixels
from stackweave.operators.dictionary import fit_atoms, initial_atoms, sparse_encode
from stackweave.operators.elementwise import trim_frames
from stackweave.operators.filters import median_filter, reset_minimum
from stackweave.operators.normalize import normalize_min
from stackweave.operators.projections import background_subtract, projections
from stackweave.operators.registration import align, estimate_shifts
from stackweave.operators.roi import ExtractParams, MergeParams, extract_rois, label_image, masks_of, merge_rois, region_props, renumber
from stackweave.operators.sampling import shuffle_frames
from stackweave.operators.traces import roi_traces
from stackweave.session import Scratch, fit_arrow_batches
from stackweave.sources.store import DatasetStore


@dataclass(frozen=True)
class PipelineParams:
    front: int = 1
    back: int = 1
    median_size: int = 3
    register_rounds: int = 5
    template_history: float = 0.25
    stop_distance: float = 0.0
    n_atoms: int = 50
    alpha: float = 0.2
    fit_rounds: int = 10
    fit_chunks: int = 1
    code_atoms: int | None = None
    seed: int = 0
    extract: ExtractParams = field(default_factory=ExtractParams)
    merge: MergeParams = field(default_factory=MergeParams)


def run_pipeline(store: DatasetStore, frames: DataFrame, params: PipelineParams = PipelineParams()) -> DatasetStore:
    """Run all stages on raw frames; the results lie in ``store`` under their stage names."""
    p, spark = params, store.spark
    raw = store.put("raw", promote(frames))

    def stage(name: str, made: DataFrame) -> DataFrame:
        """Images are stored in the working type, whatever the arithmetic made of them."""
        return store.put(name, as_type_of(made, raw))

    fit_arrow_batches(spark, raw.agg(F.max(F.size("px"))).first()[0] or 1)
    trimmed = stage("trim", trim_frames(raw, p.front, p.back))
    scratch = Scratch(spark, "pipeline")
    filtered = scratch.write(as_type_of(median_filter(trimmed, p.median_size), raw))
    clean = stage("dn", reset_minimum(filtered, trimmed))
    shifted = scratch.write(estimate_shifts(clean, p.register_rounds, p.template_history, p.stop_distance))
    stored = store.put_many(["reg/images", "reg/shifts"], [as_type_of(align(shifted), raw), shifted.select("t", "dy", "dx")])
    images = stored["reg/images"]
    stats = scratch.write(projections(images))
    for name in ("hmean", "max", "mean", "std"):
        store.put(f"proj/{name}", stats.select("y", "x", F.col(name).alias("value")))
    sub = stage("sub", background_subtract(images, stats))
    normed = stage("norm", normalize_min(sub))
    shuffled = stage("dict_init_data", shuffle_frames(normed, p.seed))
    first = stage("dict_init_dict", initial_atoms(normed, p.n_atoms, p.seed))
    atoms = stage("dict", fit_atoms(shuffled, first, p.alpha, p.fit_rounds, p.fit_chunks, scratch=scratch))
    store.put("code", sparse_encode(normed, atoms, k=p.code_atoms))
    _, found = extract_rois(atoms, scratch, p.extract)
    merged = scratch.write(merge_rois(scratch.write(found), scratch, p.merge))
    pixels = renumber(merged)
    pixels = store.put("post/pixels", pixels)
    store.put("post/rois", region_props(pixels, "roi_id"))
    masks = store.put("rois/masks", masks_of(pixels))
    size = images.agg(F.max("h").alias("h"), F.max("w").alias("w")).first()
    store.put("rois/labels", label_image(masks, (size["h"], size["w"])))
    store.put("traces", roi_traces(sub, masks, store["post/rois"].select("roi_id")))
    scratch.clear()
    return store


def stack_of(store: DatasetStore, name: str) -> DataFrame:
    """A stored stack in pixel form."""
    return to_pixels(store[name])
