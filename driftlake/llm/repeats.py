"""Suffix-array dedup: depth-limited radix passes over the suffixes of all documents.

Two suffixes are ordered only through their first ``WINDOW`` bytes; groups that agree so
far are the repeated windows.  The passes go from coarse to fine digits and a suffix
leaves as soon as it is alone:

1. The first digit of a suffix is the least hash of the ``K``-byte strings in its window.
   Equal windows have equal digits, and neighbouring suffixes mostly share one, so a run
   of them (about thirteen) is one key.  Sending every suffix would cost sixteen bytes for
   each byte of text.
2. Within a digit, the text under the run is the second digit.  A run that a smaller
   document has too is repeated as a whole; a digit with one text only is done.
3. What is left (a digit with several texts) is ordered by whole windows.

Blocks follow the order of ``doc_id``, so a window is in a smaller document if a block
before has it, or the same block in a smaller document.  Hashes are 64 and more bits wide.

Defined results: null and empty texts have no bytes; texts under ``WINDOW`` bytes lose
nothing.  A null ``doc_id`` counts as larger than all others.  Rows that repeat a ``doc_id``
do not remove each other's bytes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from driftlake.llm.blocks import SENT, Block, answers, ask, blocked, send
from driftlake.llm.common import given, width

#: Bytes of a repeated string, of the strings whose least hash is a digit, and of a sweep.
WINDOW, K, SWEEP = 50, 24, 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
NOWHERE, WHOLE, UNCLEAR = 0, 1, 2


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Sweep:
    """Windows that start in ``[start, stop)`` of a block's buffer, as runs of equal digits."""

    def __init__(self, buffer: np.ndarray, block: Block, start: int, stop: int):
        self.start = start
        data = buffer[start : stop + WINDOW - 1]
        up, down = _powers(SWEEP + WINDOW)
        self.down = down
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=prefix[1:])
        self.prefix = prefix
        count = len(data) - WINDOW + 1
        low = _mix((prefix[K:] - prefix[:-K]) * down[: len(data) - K + 1], 1)
        span, reach = 1, WINDOW - K + 1
        while span * 2 <= reach:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < reach:
            low = np.minimum(low[: count], low[reach - span : reach - span + count])
        valid = np.ones(count, bool)
        first, last = np.searchsorted(block.ends, start, "right"), np.searchsorted(block.begins, stop, "left")
        for begin, end in zip(block.begins[first:last], block.ends[first:last]):
            valid[max(max(begin, end - WINDOW + 1) - start, 0) : max(end - start, 0)] = False
        fresh = valid.copy()
        fresh[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
        self.at = np.flatnonzero(fresh)
        stops = np.flatnonzero(valid & ~np.append(valid[1:] & ~fresh[1:], False)) + 1
        self.size = stops - self.at
        self.digit = low[self.at] >> np.uint64(16)
        self.text = _mix(self._hash(self.at, self.size + WINDOW - 1) + self.size.astype(np.uint64), 2) >> np.uint64(16)
        self.rank = block.rank[np.searchsorted(block.ends, self.at + start, "right")].astype(np.uint64)

    def _hash(self, at: np.ndarray, length) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.down[at]

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, rank and start of each window of the chosen runs."""
        size = self.size[chosen]
        at = np.repeat(self.at[chosen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return _mix(self._hash(at, WINDOW), 3), np.repeat(self.rank[chosen], size), at + self.start


def sweeps(block: Block) -> list[Sweep]:
    buffer = np.frombuffer(b"".join(block.texts), np.uint8)
    total = len(buffer) - WINDOW + 1
    return [Sweep(buffer, block, s, min(s + SWEEP, total)) for s in range(0, max(total, 0), SWEEP)]


class Runs:
    """All runs of a block; equal ones (digit and text) are one entry with its smallest document."""

    def __init__(self, block: Block):
        self.sweeps = sweeps(block)
        none = [np.empty(0, np.uint64)]
        digit = np.concatenate(none + [s.digit for s in self.sweeps])
        text = np.concatenate(none + [s.text for s in self.sweeps])
        self.rank = np.concatenate(none + [s.rank for s in self.sweeps])
        high = digit << np.uint64(16) | text >> np.uint64(32)
        low = text << np.uint64(32) | self.rank
        order = np.lexsort((low, high))
        new = np.ones(len(order), bool)
        sorted_high, sorted_text = high[order], text[order]
        new[1:] = (sorted_high[1:] != sorted_high[:-1]) | (sorted_text[1:] != sorted_text[:-1])
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        heads = order[new]
        self.digits, self.texts, self.least = digit[heads], text[heads], self.rank[heads]

    def packed(self) -> list[np.ndarray]:
        """Three 32-bit columns for each entry: 96 bits of digit and text."""
        middle = (self.digits & np.uint64(0xFFFF)) << np.uint64(16) | self.texts >> np.uint64(32)
        return [
            (self.digits >> np.uint64(16)).astype(np.uint32),
            middle.astype(np.uint32),
            (self.texts & np.uint64(0xFFFFFFFF)).astype(np.uint32),
        ]

    def windows(self, status: np.ndarray):
        """Windows of the unclear runs: their keys, the least rank of each, and where they are."""
        found = [(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))]
        done = 0
        for sweep in self.sweeps:
            entry = self.entry[done : done + len(sweep.at)]
            # A later copy within the block is repeated as a whole; the first one stands for it.
            chosen = (status[entry] == UNCLEAR) & (sweep.rank == self.least[entry])
            found.append(sweep.windows(np.flatnonzero(chosen)))
            done += len(sweep.at)
        keys, rank, at = (np.concatenate(x) for x in zip(*found))
        unique, inverse = np.unique(keys, return_inverse=True)
        least = np.full(len(unique), np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, inverse, rank)
        return unique, inverse, least, rank, at


def _reply_runs(columns: list[np.ndarray], parts: np.ndarray) -> list[np.ndarray]:
    """For each entry: in a block before, nowhere else, or its digit has other texts."""
    sizes = [c.shape[1] for c in columns]
    a, b, c = (x.astype(np.uint64) for x in np.concatenate(columns, axis=1))
    digit = a << np.uint64(16) | b >> np.uint64(16)
    part = np.repeat(parts, sizes)
    high, low = a << np.uint64(32) | b, c
    order = np.lexsort((part, low, high))
    d, h, t, p = digit[order], high[order], low[order], part[order]
    new_digit = np.append(True, d[1:] != d[:-1])
    new_text = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))
    group = np.cumsum(new_digit) - 1
    several = np.bincount(group, weights=new_text)[group] > 1
    first = np.maximum.accumulate(np.where(new_text, np.arange(len(p)), 0))
    status = np.where(p > p[first], WHOLE, np.where(several, UNCLEAR, NOWHERE)).astype(np.uint8)
    out = np.empty(len(order), np.uint8)
    out[order] = status
    return np.split(out, np.cumsum(sizes)[:-1])


def _reply_windows(columns: list[np.ndarray], parts: np.ndarray) -> list[np.ndarray]:
    """For each window: whether a block before has it."""
    sizes = [c.shape[1] for c in columns]
    high, low = (x.astype(np.uint64) for x in np.concatenate(columns, axis=1))
    part = np.repeat(parts, sizes)
    key = high << np.uint64(32) | low
    order = np.lexsort((part, key))
    k, p = key[order], part[order]
    new = np.append(True, k[1:] != k[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))
    out = np.empty(len(order), np.uint8)
    out[order] = p > p[first]
    return np.split(out, np.cumsum(sizes)[:-1])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _repeated(block: Block, runs: Runs, status: np.ndarray, windows, before: np.ndarray) -> np.ndarray:
    """Whether each byte of the block's buffer is covered by a repeated window."""
    steps = np.zeros(int(block.ends[-1]) + WINDOW + 1, np.int32)
    done = 0
    for sweep in runs.sweeps:
        entry = runs.entry[done : done + len(sweep.at)]
        all_of_it = (status[entry] == WHOLE) | (sweep.rank > runs.least[entry])
        at = sweep.at[all_of_it] + sweep.start
        np.add.at(steps, at, 1)
        np.add.at(steps, at + sweep.size[all_of_it] + WINDOW - 1, -1)
        done += len(sweep.at)
    _, inverse, least, rank, at = windows
    at = at[(before[inverse] == 1) | (rank > least[inverse])]
    np.add.at(steps, at, 1)
    np.add.at(steps, at + WINDOW, -1)
    return np.cumsum(steps)[: int(block.ends[-1])] > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``."""
    table, buckets = blocked(docs), width(docs.sparkSession)

    def send_runs(rows: pa.Table) -> pa.Table:
        block = Block(rows)
        runs = Runs(block)
        return send(block, runs.digits, runs.packed(), buckets)

    def send_windows(rows: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(rows)
        runs = Runs(block)
        keys = runs.windows(answers(told, "runs", runs.digits, buckets, np.uint8))[0]
        halves = [(keys >> np.uint64(32)).astype(np.uint32), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)]
        return send(block, keys, halves, buckets)

    def decide(rows: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(rows)
        runs = Runs(block)
        status = answers(told, "runs", runs.digits, buckets, np.uint8)
        windows = runs.windows(status)
        before = answers(told, "windows", windows[0], buckets, np.uint8)
        gone = _repeated(block, runs, status, windows, before)
        done = []
        for doc_id, text, begin, end in zip(block.doc_ids, block.texts, block.begins, block.ends):
            own = gone[begin:end]
            spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if len(own) else 0
            kept = np.frombuffer(text, np.uint8)[~own].tobytes() if spans else text
            done.append((doc_id, len(text), int(own.sum()), spans, hashlib.sha256(kept).hexdigest()))
        names = [part.split()[0] for part in RESULT.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.table([pa.array(x, kind) for x, kind in zip(zip(*done), kinds)], names=names)

    sent = table.groupBy("block").applyInArrow(send_runs, SENT)
    of_runs = ask(sent, "runs", _reply_runs, 3)
    sent = table.groupBy("block").cogroup(of_runs.groupBy("block")).applyInArrow(send_windows, SENT)
    of_windows = ask(sent, "windows", _reply_windows, 2)
    told = of_runs.unionByName(of_windows)
    return table.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(decide, RESULT)


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(given(spark, folder, "documents"))
