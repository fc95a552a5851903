"""Byte-level BPE over whole texts: contiguous rank arrays for short words, a heap for long ones."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stackweave.llm.batches import add_columns, texts_of

#: Above so many bytes a word's merges are found with a heap instead of repeated scans.
SHORT_WORD = 96
#: Runs whose ids one Python worker remembers before it starts anew, and the longest one remembered.
CACHED_RUNS, CACHED_CHARS = 250_000, 40
NO_RANK = (1 << 31) - 1

# Fixed value: the word pattern of this family of tokenizers, with white space as Unicode defines it.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


BLANK_BESIDE_SPACE = re.compile(r"\s | \s|^ | $")


def blank_runs(text: str) -> list[str]:
    """``text`` cut before its blanks, except next to other white space."""
    runs = [" " + r for r in text.split(" ")]
    runs[0] = runs[0][1:]
    if BLANK_BESIDE_SPACE.search(text):
        joined: list[str] = []
        for run in runs:
            if joined and (len(run) == 1 or run[1].isspace() or joined[-1][-1:].isspace() or not joined[-1]):
                joined[-1] += run
            else:
                joined.append(run)
        return joined
    return runs


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in vocabulary files: printable ones for themselves, the rest from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BytePairs:
    """Encoder and decoder of one vocabulary file (JSON with vocab, merges and added tokens)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab, signs = content["model"]["vocab"], byte_signs()
        self.added = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.first = [0] * 256
        for sign, byte in signs.items():
            self.first[byte] = vocab[sign]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        # (left id, right id) -> rank; rank -> id of both
        self.pairs = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = np.array([vocab[a + b] for a, b in pairs] or [0], dtype=np.int32)
        self._hash_pairs()
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes = [b""] * size
        for token, number in vocab.items():
            self.token_bytes[number] = bytes(signs[s] for s in token)
        for token, number in self.added.items():
            self.token_bytes[number] = token.encode()
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.known: dict[str, bytes] = {}

    def _hash_pairs(self) -> None:
        """An open table of the pairs for lookups of whole arrays: a quarter full at most."""
        self.bits = max(4, (4 * len(self.pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, dtype=np.int32)
        self.probes = 1
        left, right = (np.array([p[k] for p in self.pairs], dtype=np.int64) for k in (0, 1))
        for key, slot, rank in zip(((left << 32) | right).tolist(), self._slots((left << 32) | right).tolist(), self.pairs.values()):
            probe = 0
            while self.keys[slot] >= 0:
                slot, probe = (slot + 1) & ((1 << self.bits) - 1), probe + 1
            self.keys[slot], self.ranks[slot], self.probes = key, rank, max(self.probes, probe + 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: int, right: int) -> int:
        return self.pairs.get((left, right), NO_RANK)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of neighbouring parts; -1 marks the end of a word and has none."""
        keys = (left.astype(np.int64) << 32) | right
        slots = self._slots(keys)
        there = self.keys[slots]
        same = there == keys
        found = np.where(same, self.ranks[slots], NO_RANK)
        open_ = np.flatnonzero(~same & (there >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = (slots[open_] + probe) & ((1 << self.bits) - 1)
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit & (self.keys[at] >= 0)]
        found[(left < 0) | (right < 0)] = NO_RANK
        return found

    def short_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of about the same length, all of them at once.

        One row per word: ``parts`` holds the ids between its boundaries, ``ranks`` the rank of each
        part with the next, both contiguous from the left. Each turn scans every open word's ranks
        for the minimum, deletes that boundary and refreshes the ranks on its two sides.
        """
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(len(words), width)
        parts = np.array(self.first, dtype=np.int32)[flat]
        columns = np.arange(width)
        parts[columns >= lengths[:, None]] = -1
        out: list[bytes] = [b""] * len(words)
        who = np.arange(len(words))
        edge = np.full((len(words), 1), -1, dtype=np.int32)
        ranks = self.pair_ranks(parts.ravel(), np.hstack([parts[:, 1:], edge]).ravel()).reshape(parts.shape)
        while len(who):
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(who)), at]
            done = low == NO_RANK
            if done.any():
                ended = parts[done]
                packed, step = ended.astype("<u4").tobytes(), 4 * width
                for row, (k, n) in enumerate(zip(who[done].tolist(), (ended >= 0).sum(axis=1).tolist())):
                    out[k] = packed[row * step : row * step + 4 * n]
                who, parts, ranks, at, low = who[~done], parts[~done], ranks[~done], at[~done], low[~done]
                if not len(who):
                    break
            rows = np.arange(len(who))
            parts[rows, at] = self.merged[low]
            shift = columns[:-1] >= at[:, None]
            ranks[:, :-1] = np.where(shift, ranks[:, 1:], ranks[:, :-1])
            parts[:, 1:-1] = np.where(shift[:, :-1], parts[:, 2:], parts[:, 1:-1])
            parts[:, -1], ranks[:, -1] = -1, NO_RANK
            here, before, after = parts[rows, at], np.maximum(at - 1, 0), np.minimum(at + 1, width - 1)
            right = np.where(at + 1 < width, parts[rows, after], -1)
            ranks[rows, at] = self.pair_ranks(here, right)
            left = np.where(at > 0, parts[rows, before], -1)
            ranks[rows, before] = np.where(at > 0, self.pair_ranks(left, here), ranks[rows, before])
        return out

    def long_word(self, data: bytes) -> list[int]:
        """The same merges in n log n steps: a heap of (rank, place), links between neighbours."""
        ids = [self.first[b] for b in data]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(self._rank(a, b), k, a, b) for k, (a, b) in enumerate(zip(ids, ids[1:]))]
        heap = [h for h in heap if h[0] < NO_RANK]
        heapq.heapify(heap)
        while heap:
            _, at, left, right = heapq.heappop(heap)
            other = after[at]
            if ids[at] != left or other >= len(ids) or ids[other] != right:
                continue
            ids[at], ids[other] = int(self.merged[self.pairs[left, right]]), -1
            after[at] = after[other]
            if after[at] < len(ids):
                before[after[at]] = at
            for a in (before[at], at):
                b = after[a] if a >= 0 else len(ids)
                if b < len(ids) and (rank := self._rank(ids[a], ids[b])) < NO_RANK:
                    heapq.heappush(heap, (rank, a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of the words not remembered yet: short ones together by length, long ones alone."""
        out, by_size = {}, {}
        for word in words:
            data = word.encode()
            if len(data) > SHORT_WORD:
                out[word] = np.asarray(self.long_word(data), dtype="<u4").tobytes()
            else:
                by_size.setdefault((len(data) + 3) // 4, []).append((word, data))
        for group in by_size.values():
            out.update(zip([w for w, _ in group], self.short_words([d for _, d in group])))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers; added tokens in a text keep their id.

        Texts are cut before each lone blank between other signs, where a word always begins, so a
        run is looked up as a whole; the word pattern only sees runs that are not remembered.
        """
        pieces = [[blank_runs(p) if k % 2 == 0 else p for k, p in enumerate(self._pieces(t))] for t in texts]
        wanted = {r for own in pieces for runs in own[::2] for r in runs}
        if len(self.known) > CACHED_RUNS:
            self.known.clear()
        known = self.known
        words = {r: WORDS.findall(r) for r in wanted.difference(known)}
        ids = self.learn({w for own in words.values() for w in own})
        fresh = {r: b"".join([ids[w] for w in own]) for r, own in words.items()}
        known.update(fresh)
        out = []
        for own in pieces:
            parts = [np.uint32(self.added[p]).astype("<u4").tobytes() if k % 2 else b"".join(map(known.__getitem__, p)) for k, p in enumerate(own)]
            out.append(parts[0] if len(parts) == 1 else b"".join(parts))
        for run in fresh:
            if len(run) > CACHED_CHARS:
                del known[run]
        return out

    def _pieces(self, text: str) -> list[str]:
        """Plain text and added tokens in turn."""
        if self.splitter is None:
            return [text]
        return self.splitter.split(text)

    def decode(self, packed: bytes) -> str:
        ids = array("I", packed) if array("I").itemsize == 4 else np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", errors="replace")


_loaded: dict[str, BytePairs] = {}


def tokenizer(path: str) -> BytePairs:
    """One per worker and file; vocabulary files are installed on every node."""
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]


def tokenised(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids`` and ``decoded``.

    Whole texts are encoded with the vocabulary at ``path`` and decoded again; null counts as empty
    and has no tokens. A narrow map over slices of rows: repeated rows give repeated results, an
    empty table an empty one, and columns of the same names are replaced.
    """
    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())]

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        coder = tokenizer(path)
        made: dict[str, list] = {name: [] for name, _ in fields}
        for packed in coder.encode(texts_of(batch)):
            decoded = coder.decode(packed)
            made["n_tokens"].append(len(packed) // 4)
            made["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
            made["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            if with_ids:
                made["ids"].append(np.frombuffer(packed, "<u4").astype(np.int32))
                made["decoded"].append(decoded)
        return made

    return add_columns(docs, fields, work)
