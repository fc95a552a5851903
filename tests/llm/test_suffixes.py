"""Suffix sorting against plain sorting, and the removal of repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stackweave.llm import induce, suffix_dedup
from stackweave.session import Scratch


def all_suffixes(symbols, memory, cap):
    text = np.zeros(len(symbols) + 8, np.uint8)
    text[:len(symbols)] = symbols
    pos, common = [], []
    with induce.Disk(memory) as disk:
        induce.sorted_suffixes(text, len(symbols), 256, disk, lambda p, c, _: (pos.append(p), common.append(c)), cap)
        spilled = disk.spilled
    return np.concatenate(pos), np.concatenate(common), spilled


@pytest.mark.parametrize("seed", range(60))
def test_suffix_order(seed, monkeypatch):
    """Every order and common prefix, with the queue in memory, in files and in tiny cells, and names sorted by induction again."""
    rng = random.Random(seed)
    for name, value in zip(("CELL", "BATCH", "BLOCK"), rng.choice([(1 << 15, 1 << 12, 1 << 18), (4, 3, 7), (16, 4, 50)])):
        monkeypatch.setattr(induce, name, value)
    kinds = rng.choice([1, 2, 3, 10, 200])
    symbols = [rng.randint(1, kinds) if rng.random() < 0.95 else 0 for _ in range(rng.randint(2, 300))] * rng.choice([1, 1, 3])
    symbols[-1] = 0
    cap, memory = rng.choice([3, 10, 200]), rng.choice([1 << 26, 20_000, 1000, 100])
    pos, common, spilled = all_suffixes(symbols, memory, cap)
    raw = bytes(symbols)
    assert sorted(pos.tolist()) == list(range(len(raw)))
    starts = [raw[p:p + cap] for p in pos[::-1].tolist()]
    assert starts == sorted(starts)
    for a, b, n in zip(pos.tolist(), pos[1:].tolist(), common[1:].tolist()):
        same = next((k for k, (x, y) in enumerate(zip(raw[a:], raw[b:])) if x != y), min(len(raw) - a, len(raw) - b))
        assert n == min(same, cap)
    assert spilled or memory > 100 or len(raw) < 50


def test_recursion_on_disk(monkeypatch):
    """A text whose names exceed the memory is sorted by names of names, all in files."""
    rng = np.random.default_rng(1)
    monkeypatch.setattr(induce, "CELL", 256)
    monkeypatch.setattr(induce, "BLOCK", 1 << 12)
    levels = []
    whole = induce.name_order
    monkeypatch.setattr(induce, "name_order", lambda names, *rest: levels.append(len(names)) or whole(names, *rest))
    symbols = np.append(np.tile(rng.integers(1, 5, 3000), 4), 0)
    pos, common, spilled = all_suffixes(symbols, 5000, 200)
    small, same, _ = all_suffixes(symbols, 1 << 28, 200)
    assert len(levels) > 2 and spilled > 20 and np.array_equal(np.sort(pos), np.sort(small))
    assert np.array_equal(common, same)


def told(rows, length=suffix_dedup.LENGTH):
    texts = [(text or "").encode() for _, text, *_ in rows]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, *_), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(t) else 0
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)

    def words(n):
        return " ".join("".join(rng.choice("abcdé漢🙂\x00\x7f") for _ in range(rng.randint(1, 9))) for _ in range(n))

    passage, shared = words(60), words(90)
    out = [(None, None), (1, ""), (2, "a"), (3, "x" * 199), (4, "x" * 200), (5, "ab" * 400), (6, "q" * 5000), (7, words(12_000)), (8, words(200) + "\n" + "r" * 201)]
    out += [(10 + k, words(rng.randint(1, 80)) + passage + words(rng.randint(0, 80))) for k in range(60)]
    out += [(100 + k, shared) for k in range(30)] + [(100, shared), (None, shared), (None, words(70))]
    base = words(150)
    for k in range(20):
        at = rng.randrange(len(base))
        out.append((200 + k, base[:at] + "#" + base[at:]))
    exactly = "z" + words(80)[:150]
    exactly = exactly.encode()[:200].decode(errors="ignore")
    exactly += "k" * (200 - len(exactly.encode()))
    out += [(300, "left" + exactly + "right"), (301, exactly), (302, "1" + exactly[:-1] + "other"), (303, exactly[1:] + "9")]
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_PIECES, 2])
def test_repeated_strings_go(spark, rows, hot):
    table = spark.createDataFrame([r + ("x", 1, "y") for r in rows], "doc_id long, text string, chunk string, n long, piece string").repartition(5)
    found = suffix_dedup.dedup(table, Scratch(spark, "suffixes"), with_text=True, hot_pieces=hot)
    got = sorted(((r[0], r[1], r[2], r[3], r[4], bytes(r[5])) for r in found.collect()), key=repr)
    assert got == told(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.dedup(empty, Scratch(spark, "suffixes")).collect() == []


def test_names_are_equal_for_equal_windows(monkeypatch):
    """Whatever block a window is hashed in and whatever stands around it; repeated places are marked."""
    rng = np.random.default_rng(5)
    core = rng.integers(0, 255, 450).astype(np.uint8)
    names = []
    for block, before in ((1 << 21, 0), (300, 37), (77, 500)):
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
        data = np.concatenate((rng.integers(0, 255, before).astype(np.uint8), core))
        for gram in (suffix_dedup.GRAM, *suffix_dedup.LONGER_GRAMS):
            at = {}
            for first, last, name, _ in suffix_dedup.named_runs(data, suffix_dedup.window_starts(np.array([0, len(data)])), gram):
                for a, b, h in zip(first, last, name):
                    at |= {i - before: h for i in range(a, b + 1) if i >= before}
            assert sorted(at) == list(range(251))
            names.append((gram, at))
    assert all(at == other for gram, at in names for again, other in names if gram == again)
    data = np.full(201, 7, np.uint8)
    marks = np.concatenate([m for *_, m in suffix_dedup.named_runs(data, np.arange(201) < 2, 16)])
    assert len(marks) > len(np.unique(marks))


def test_repeated_names_across_batches():
    rng = np.random.default_rng(8)
    for size in (1, 2, 3, 100):
        name = np.sort(rng.integers(0, 60, 80))
        known = rng.random(80) < 0.1
        table = pa.table({"chunk": np.arange(80), "name": name, "known": known})
        got = [(r["chunk"], r["name"]) for b in suffix_dedup.repeated_names(table.to_batches(max_chunksize=size)) for r in b.to_pylist()]
        many = Counter(name.tolist())
        assert sorted(got) == [(k, n) for k, n in enumerate(name.tolist()) if many[n] > 1 or known[k]]


def test_shard_in_files():
    """A shard whose text and queue do not fit into memory tells the same windows."""
    rng = random.Random(4)
    pieces = sorted({bytes(rng.choice(b"ab") for _ in range(150)) + bytes(rng.choice(b"cd") for _ in range(rng.randint(50, 150))) for _ in range(20)})
    pieces += [p[3:] + b"tail" for p in pieces[:10] if len(p) > 203]
    results = []
    for memory in (1 << 28, 3000):
        with induce.Disk(memory) as disk:
            shard = suffix_dedup.Shard(disk)
            for k, p in enumerate(pieces):
                shard.add(k.to_bytes(2), p, 1)
            results.append(list(shard.spans()))
            assert (disk.spilled > 0) == (memory == 3000)
    assert results[0] == results[1] and len(results[0]) >= 10


def test_query_against_brute_force(spark):
    """The registered query over the whole smallest table."""
    from stackweave.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op11_suffixes"](spark, sf).collect()), key=repr)
    assert got == [r[:5] for r in told(rows)]
