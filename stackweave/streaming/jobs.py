"""Traces and dictionary learning on a stream of frames.

Both run as ``foreachBatch`` jobs. A batch that is run again after a failure overwrites or
skips its own output, so nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stackweave.operators import tiled
from stackweave.operators.dictionary import Learned, fit, initial_atoms, state_from_tables, state_tables
from stackweave.operators.traces import roi_traces
from stackweave.session import Scratch
from stackweave.sources.store import DatasetStore

STATE_TABLES = ("dict", "dict_A", "dict_B", "dict_rounds")


def stream_traces(frames: DataFrame, roi_pixels: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the traces of newly arrived frames below ``out``, one folder per batch."""
    def write(batch: DataFrame, epoch: int) -> None:
        roi_traces(batch, roi_pixels).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return frames.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_traces(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).select("roi_id", "t", "value")


def save_state(store: DatasetStore, learned: Learned, epoch: int) -> None:
    """Write the state of one batch, its round count last, then drop older states."""
    tables = state_tables(store.spark, learned)
    group = f"state/{epoch:09d}"
    for name in STATE_TABLES:
        store.put(f"{group}/{name}", tables[name])
    for old in {n.split("/")[1] for n in store if n.startswith("state/")} - {f"{epoch:09d}"}:
        store.drop(f"state/{old}")


def load_state(store: DatasetStore) -> tuple[Learned | None, int]:
    """The newest complete state and its batch number, or nothing."""
    done = sorted(n.split("/")[1] for n in store if n.startswith("state/") and n.endswith("/dict_rounds"))
    if not done:
        return None, -1
    return state_from_tables({n: store.get(f"state/{done[-1]}/{n}") for n in STATE_TABLES}), int(done[-1])


def stream_fit(
    frames: DataFrame, store: DatasetStore, checkpoint: str, n_atoms: int, alpha: float, rounds: int = 1, seed: int = 0
) -> StreamingQuery:
    """Update a stored dictionary with every batch of new frames."""
    def learn(batch: DataFrame, epoch: int) -> None:
        state, last = load_state(store)
        if epoch <= last or batch.isEmpty():
            return
        save_state(store, fit(batch, n_atoms, alpha, rounds, seed=seed, state=state), epoch)

    return frames.writeStream.foreachBatch(learn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


TILE_TABLES = ("tiles", "square", "about")


def load_tiles(store: DatasetStore) -> tuple[tiled.TileState | None, int]:
    """The newest complete state in tiles and its batch number, or nothing."""
    done = sorted(n.split("/")[1] for n in store if n.startswith("tiles/") and n.endswith("/about"))
    if not done:
        return None, -1
    return tiled.state_from_tables({n: store.get(f"tiles/{done[-1]}/{n}") for n in TILE_TABLES}), int(done[-1])


def stream_fit_tiles(
    frames: DataFrame, store: DatasetStore, checkpoint: str, n_atoms: int, alpha: float, rounds: int = 1, seed: int = 0, size: int | None = None, **options
) -> StreamingQuery:
    """``stream_fit`` for frames of any size: the stored state stays in tiles of ``size`` pixels.

    The row ``about`` is written last and older states go after it, so a batch that is run again finds a whole state.
    ``options`` are those of ``tiled.learn``.
    """
    def learn(batch: DataFrame, epoch: int) -> None:
        state, last = load_tiles(store)
        if epoch <= last or batch.isEmpty():
            return
        scratch = Scratch(store.spark, "stream-tiles")
        if state is None:
            state = tiled.start_state(initial_atoms(batch, n_atoms, seed), scratch, size)
        tables = tiled.state_tables(tiled.learn(batch, state, alpha, rounds, scratch, seed=seed, **options))
        for name in TILE_TABLES:
            store.put(f"tiles/{epoch:09d}/{name}", tables[name])
        for old in {n.split("/")[1] for n in store if n.startswith("tiles/")} - {f"{epoch:09d}"}:
            for name in reversed(TILE_TABLES):
                store.drop(f"tiles/{old}/{name}")
        scratch.clear()

    return frames.writeStream.foreachBatch(learn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
