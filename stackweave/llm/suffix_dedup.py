"""Removal of byte strings that occur again anywhere, by suffix sorting of shards larger than memory."""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.llm import induce
from stackweave.llm.warc import open_uri
from stackweave.session import Scratch, hadoop_path

#: A string of so many bytes that starts twice goes.
LENGTH = 200
#: Bytes of the grams whose smallest hash names a window.
GRAM = 32
#: Text bytes of a chunk, which one task works on, and piece bytes of a shard, on average.
CHUNK_BYTES, SHARD_BYTES = 8 << 20, 3 << 20
#: Pieces of one name beyond which its windows get names by the longer grams, one length after the other.
HOT_PIECES, LONGER_GRAMS = 20_000, (137, 185, 197, 200)
#: Windows that one piece covers at most, and bytes hashed at once.
PIECE_WINDOWS, BLOCK_BYTES = 4096, 1 << 20
MULTIPLIER = 0xD6E8FEB86659FD93
#: Text bytes are raised by one in a shard: 0 ends a piece.
RAISED = bytes((k + 1) & 255 for k in range(256))
PIECES = pa.schema([("name", pa.int64()), ("piece_id", pa.binary()), ("piece", pa.binary()), ("n", pa.int64()),
                    ("seen", pa.int64()), ("chunk", pa.int64()), ("places", pa.binary())])
PIECES_SQL = "name long, piece_id binary, piece binary, n long, seen long, chunk long, places binary"


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes, from hashes of doubled lengths."""
    power = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    count, span, factor, done, out = len(data) - gram + 1, 1, MULTIPLIER, 0, None
    while True:
        if gram & span:
            part = power[done:done + count]
            out = part.copy() if out is None else out * np.uint64(factor) + part
            done += span
        if span * 2 > gram:
            break
        left = power[:-span]
        power = left * np.uint64(factor) + (power[span:] ^ (power[span:] >> np.uint64(29)))
        factor, span = factor * factor % (1 << 64), span * 2
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every ``width`` neighbours."""
    span, size = values, 1
    while size * 2 <= width:
        span, size = best(span[:-size], span[size:]), size * 2
    return best(span[:-(width - size)], span[width - size:]) if size < width else span


def window_starts(offsets: np.ndarray) -> np.ndarray:
    """Mask of the positions at which a window of ``LENGTH`` bytes lies in one text."""
    valid = np.ones(offsets[-1], bool)
    for end, size in zip(offsets[1:].tolist(), np.diff(offsets).tolist()):
        valid[end - min(size, LENGTH - 1):end] = False
    return valid


def named_runs(data: np.ndarray, valid: np.ndarray, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of ``(first, last, name, marks)``: runs of windows that share the smallest gram hash, their name.

    Equal windows have equal names. ``marks`` are the names at the places where a gram gives one: a name that two
    places give may belong to equal windows, any other may not.
    """
    width = LENGTH - gram + 1
    for start in range(0, len(valid), BLOCK_BYTES):
        stop = min(len(valid), start + BLOCK_BYTES)
        here = data[start:stop + LENGTH - 1]
        count = len(here) - LENGTH + 1
        if count <= 0 or not valid[start:start + count].any():
            continue
        grams = gram_hashes(here, gram)
        names, ok = sliding(grams, width, np.minimum), valid[start:start + count]
        edge = np.flatnonzero((names[1:] != names[:-1]) | (ok[1:] != ok[:-1])) + 1
        first, last = np.concatenate(([0], edge)), np.concatenate((edge, [count])) - 1
        kept = ok[first]
        # A gram gives its name if some whole window around it has no smaller one.
        high = np.concatenate((np.zeros(width - 1, np.uint64), np.where(ok, names, 0), np.zeros(width - 1, np.uint64)))
        marks = grams[grams == sliding(high, width, np.maximum)]
        yield first[kept] + start, last[kept] + start, names[first[kept]].view(np.int64), marks.view(np.int64)


def _chunks(folder: str):
    """Texts to chunk files, and the names of their windows: ``chunk, name, known``; ``name`` null lists the chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_uri(folder)
        files.create_dir(root, recursive=True)
        held, size = [], 0

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            chunk = secrets.randbits(62)
            with files.open_output_stream(f"{root}/{chunk}", compression=None) as out:
                with pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_table(table)
            data, offsets = bytes_of(table)
            valid = window_starts(offsets)
            marks = [m for *_, m in named_runs(data, valid, GRAM)]
            names, count = np.unique(np.concatenate([np.empty(0, np.int64), *marks]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(names) + 1, chunk)), pa.concat_arrays([pa.array(names), pa.nulls(1, pa.int64())]),
                                               pa.array(np.append(count > 1, False))], names=["chunk", "name", "known"])

        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")], names=["doc_id", "text"])
            sizes = pc.binary_length(batch.column("text")).to_numpy()
            first = 0
            for k, n in enumerate(sizes.tolist(), 1):
                size += n
                if size >= CHUNK_BYTES:
                    held.append(batch.slice(first, k - first))
                    yield close()
                    first, size = k, 0
            if first < len(batch):
                held.append(batch.slice(first))
        if held:
            yield close()

    return run


def bytes_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All text bytes of a chunk, one text after the other, and where each begins."""
    texts = table.column("text").combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def read_chunk(folder: str, chunk: int) -> pa.Table:
    files, root = open_uri(folder)
    with files.open_input_file(f"{root}/{chunk}") as source:
        return pa.ipc.open_file(source).read_all().combine_chunks()


def repeated_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of name: those whose name comes again, in another chunk or their own."""
    behind, open_row = None, None

    def out(chunk, name):
        return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(name, pa.int64())], names=["chunk", "name"])

    for batch in batches:
        if not len(batch):
            continue
        name, chunk = batch.column("name").to_numpy(), batch.column("chunk").to_numpy()
        known = batch.column("known").to_numpy(zero_copy_only=False)
        equal = name[1:] == name[:-1]
        again = known | np.concatenate(([name[0] == behind], equal)) | np.concatenate((equal, [False]))
        if open_row is not None and open_row[1] == name[0]:
            yield out([open_row[0]], [open_row[1]])
        open_row = None if again[-1] else (chunk[-1], name[-1])
        behind = name[-1]
        yield out(chunk[again], name[again])


class Pieces:
    """Distinct pieces of a chunk with the places they come from, given away in batches."""

    def __init__(self, chunk: int):
        self.chunk, self.rows, self.size = chunk, {}, 0

    def add(self, name: int, piece: bytes, n: int, seen: int, places: list[int] | bytes) -> None:
        key = name.to_bytes(8, "little", signed=True) + xxhash.xxh3_128_digest(piece)
        row = self.rows.get(key)
        if row is None:
            self.rows[key] = [name, xxhash.xxh3_128_digest(key + piece), piece, n, seen, bytearray(places)]
            self.size += len(piece)
        else:
            row[3] += n
            row[4] += seen
            row[5] += places

    def table(self) -> pa.Table:
        rows = list(self.rows.values())
        cells = list(zip(*rows)) if rows else [()] * 6
        places = pa.array([bytes(p) for p in cells[5]], pa.binary())
        columns = [pa.array(c, f.type) for c, f in zip(cells[:5], PIECES)]
        return pa.Table.from_arrays([*columns, pa.array([self.chunk] * len(rows), pa.int64()), places], schema=PIECES)


def _cut(folder: str):
    """The windows of a chunk whose names come again, as pieces: neighbouring windows of one name and the bytes they cover."""

    def run(key, names: pa.Table, listed: pa.Table) -> pa.Table:
        chunk = key[0].as_py()
        found = Pieces(chunk)
        if len(names) and len(listed):
            data, offsets = bytes_of(read_chunk(folder, chunk))
            wanted = np.sort(names.column("name").to_numpy())
            whole, valid = data.tobytes(), window_starts(offsets)
            for first, last, name, _ in named_runs(data, valid, GRAM):
                at = np.minimum(np.searchsorted(wanted, name), len(wanted) - 1)
                kept = wanted[at] == name
                for a, b, h in zip(first[kept].tolist(), last[kept].tolist(), name[kept].tolist()):
                    for start in range(a, b + 1, PIECE_WINDOWS):
                        stop = min(b, start + PIECE_WINDOWS - 1)
                        found.add(h, whole[start:stop + LENGTH], 1, 1, start.to_bytes(8, "little"))
        return found.table()

    return run


def _finer(gram: int):
    """Pieces cut again into runs of windows with one name by longer grams."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_chunk: dict[int, Pieces] = {}
            for row in batch.to_pylist():
                data = np.frombuffer(row["piece"], np.uint8)
                valid = window_starts(np.array([0, len(data)]))
                places = np.frombuffer(row["places"], np.int64)
                out = by_chunk.setdefault(row["chunk"], Pieces(row["chunk"]))
                for first, last, name, marks in named_runs(data, valid, gram):
                    given, count = np.unique(marks, return_counts=True)
                    twice = set(given[count > 1].tolist())
                    for a, b, h in zip(first.tolist(), last.tolist(), name.tolist()):
                        out.add(h, row["piece"][a:b + LENGTH], row["n"], row["n"] + (h in twice), (places + a).tobytes())
            for out in by_chunk.values():
                yield from out.table().to_batches()

    return run


def split_hot(pieces: DataFrame, scratch: Scratch, limit: int = HOT_PIECES) -> DataFrame:
    """``pieces`` in which no name has more than ``limit`` rows whose windows could be told apart by longer names.

    A passage that very many texts share has one name at each end for all the different pieces that reach over it. Its
    windows are named again by longer grams, which reach further into what differs; names that then come once
    go. At the last length a window is its own gram, and equal pieces are one per chunk.
    """
    for gram in LONGER_GRAMS:
        counts = pieces.groupBy("name").count().where(F.col("count") > limit).select("name")
        hot = scratch.write(counts)
        if hot.isEmpty():
            break
        cold = pieces.join(hot, "name", "left_anti")
        finer = pieces.join(hot, "name", "left_semi").select(*PIECES.names).mapInArrow(_finer(gram), PIECES_SQL)
        again = finer.groupBy("name").agg(F.sum("seen").alias("all")).where("all > 1").select("name")
        pieces = scratch.write(cold.select(*PIECES.names).unionByName(finer.join(again, "name", "left_semi").select(*PIECES.names)), compression="zstd")
    return pieces


class Shard:
    """The distinct pieces of a shard as one text, in memory or in a file."""

    def __init__(self, disk: induce.Disk):
        self.disk, self.parts, self.held, self.size, self.file = disk, [], 0, 0, None
        self.ids, self.starts, self.heavy = [], [], []

    def add(self, piece_id: bytes, piece: bytes, n: int) -> None:
        if self.ids and self.ids[-1] == piece_id:  # rows come in order of piece
            self.heavy[-1] = True
            return
        self.ids.append(piece_id)
        self.starts.append(self.size)
        self.heavy.append(n > 1)
        self.parts.append(piece.translate(RAISED))
        self.size += len(piece) + 1
        self.held += len(piece) + 1
        if self.held > self.disk.memory // 8:
            self.flush()

    def flush(self) -> None:
        self.file = self.file or self.disk.path()
        with open(self.file, "ab") as out:
            out.write(b"\0".join(self.parts) + b"\0")
        self.parts, self.held = [], 0

    def text(self) -> np.ndarray:
        """All pieces, a 0 behind each, and 8 bytes more."""
        if self.file is None:
            return np.frombuffer(b"\0".join(self.parts) + bytes(9), np.uint8)
        if self.parts:
            self.flush()
        with open(self.file, "ab") as out:
            out.write(bytes(8))
        return np.memmap(self.file, np.uint8, "r")

    def spans(self) -> Iterator[tuple[bytes, bytes]]:
        """Per piece with any: the runs of windows that start more than once, as pairs of byte places."""
        text = self.text()
        repeated = self.disk.array(self.size, np.bool_)
        last = np.empty(0, np.int64)

        def mark(pos: np.ndarray, common: np.ndarray, induced: np.ndarray) -> None:
            nonlocal last
            twin = np.flatnonzero(common >= LENGTH)
            before = np.concatenate((last, pos[:-1])) if len(last) else np.concatenate((pos[:1], pos[:-1]))
            repeated[pos[twin]] = True
            repeated[before[twin]] = True
            last = pos[-1:]

        induce.sorted_suffixes(text, self.size, 256, self.disk, mark, LENGTH)
        ends = [*self.starts[1:], self.size]
        for piece_id, start, end, heavy in zip(self.ids, self.starts, ends, self.heavy):
            if heavy:
                yield piece_id, np.array([0, end - 1 - start], np.int64).tobytes()
                continue
            # Suffixes that reach over the end of their piece are no windows, whatever they share.
            flags = np.concatenate(([False], repeated[start:end - LENGTH], [False]))
            edges = np.flatnonzero(flags[1:] != flags[:-1])
            if len(edges):
                pairs = edges.astype(np.int64)
                pairs[1::2] += LENGTH - 1
                yield piece_id, pairs.tobytes()


def shard_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of a partition's pieces and tell which windows are repeated: ``piece_id, spans``."""
    with induce.Disk() as disk:
        shard = Shard(disk)
        for batch in batches:
            for piece_id, piece, n in zip(*(batch.column(c).to_pylist() for c in ("piece_id", "piece", "n"))):
                shard.add(piece_id, piece, n)
        if not shard.ids:
            return
        rows = []
        for row in shard.spans():
            rows.append(row)
            if len(rows) == 1 << 16:
                yield _span_batch(rows)
                rows = []
        yield _span_batch(rows)


def _span_batch(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["piece_id", "spans"])


def _remaining(folder: str, with_text: bool):
    """What stays of each text of a chunk."""

    def run(key, spans: pa.Table, listed: pa.Table) -> pa.Table:
        if not len(listed):
            return schema.empty_table()
        table = read_chunk(folder, key[0].as_py())
        data, offsets = bytes_of(table)
        depth = np.zeros(len(data) + 1, np.int32)
        for places, pairs in zip(spans.column("places").to_pylist(), spans.column("spans").to_pylist()):
            at, pairs = np.frombuffer(places, np.int64), np.frombuffer(pairs, np.int64)
            for first, last in zip(pairs[::2].tolist(), pairs[1::2].tolist()):
                np.add.at(depth, at + first, 1)
                np.add.at(depth, at + last, -1)
        gone = np.cumsum(depth[:-1]) > 0
        heads = gone.copy()
        heads[1:] &= ~gone[:-1]
        begins = offsets[:-1][np.diff(offsets) > 0]
        heads[begins] = gone[begins]
        removed, runs = (np.concatenate(([0], np.cumsum(x)))[offsets] for x in (gone, heads))
        rest = data[~gone].tobytes()
        cuts = (offsets - removed).tolist()
        kept = [rest[a:b] for a, b in zip(cuts, cuts[1:])]
        columns = [table.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(removed)), pa.array(np.diff(runs)),
                   pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
        return pa.Table.from_arrays(columns + ([pa.array(kept, pa.binary())] if with_text else []), schema=schema)

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + ([("kept", pa.binary())] if with_text else []))
    return run


def _dealt(chunks: int) -> int:
    """Partitions over which chunks are dealt: their rows are few, the work on each is not."""
    return max(1, 2 * chunks if chunks < 10_000 else max(20_000, chunks // 4))


def dedup(docs: DataFrame, scratch: Scratch, with_text: bool = False, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """What stays of every text of ``docs(doc_id, text)`` without the bytes of strings of 200 bytes that start anywhere else too.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and the bytes ``kept`` if asked for, one row per row.
    Matches lie within texts, overlaps count, and all strings are judged on the input.

    Every window of 200 bytes has a name, the smallest hash of its 32-byte grams, so equal windows have one name.
    A chunk of texts sends each of its names once, however often it has it; windows whose name comes only once in
    the corpus cannot be repeated and are left. The others, with the bytes they cover, are pieces; equal pieces of a
    chunk travel as one. Pieces are dealt to shards by name, so equal windows meet in one shard. A shard's suffixes are
    sorted by external induction with their common prefixes; a window is repeated if its suffix shares 200 bytes with
    a neighbour, or its piece comes more than once. The places go back to the chunks, which cut them out.

    A shard is one task of bounded memory and any size. No name, text or copy gathers rows of all documents: a chunk
    sends a row per name and per distinct piece, and names with many different pieces are split by longer names.
    Texts stay in chunk files in the shared folder, written by name per attempt and listed when the task succeeds.

    Null texts are empty and empty texts stay as they are. Repeated rows repeat each other like any texts, whatever
    their ids, and null ids are kept. Very long texts are hashed in blocks; one text must fit a task.
    An empty table gives no rows. Other columns are ignored.
    """
    files, handle = hadoop_path(scratch.spark, f"{scratch.root}/texts")
    folder = files.makeQualified(handle).toString()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = scratch.write(rows.mapInArrow(_chunks(folder), "chunk long, name long, known boolean"))
    chunks = named.where("name is null").select("chunk")
    tasks = _dealt(chunks.count())
    sorted_names = named.where("name is not null").repartition("name").sortWithinPartitions("name")
    again = sorted_names.mapInArrow(repeated_names, "chunk long, name long")
    texts = chunks.repartition(tasks, "chunk").groupBy("chunk")
    pieces = again.repartition(tasks, "chunk").groupBy("chunk").cogroup(texts).applyInArrow(_cut(folder), PIECES_SQL)
    pieces = split_hot(scratch.write(pieces, compression="zstd"), scratch, hot_pieces)
    size = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    shards = pieces.select("name", "piece_id", "piece", "n").repartition(size // SHARD_BYTES + 1, "name").sortWithinPartitions("piece_id")
    spans = scratch.write(shards.mapInArrow(shard_spans, "piece_id binary, spans binary"))
    placed = pieces.select("piece_id", "chunk", "places").join(spans, "piece_id").select("chunk", "places", "spans")
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return placed.repartition(tasks, "chunk").groupBy("chunk").cogroup(texts).applyInArrow(_remaining(folder, with_text), fields)
