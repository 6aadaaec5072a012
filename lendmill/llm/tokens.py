"""Exact encoding with a tokenizer file, unit by unit, on Arrow buffers.

A tokenizer of the supported kinds never joins characters across certain places: at white
space for word vocabularies, before a single space between visible characters for byte
vocabularies. What stands between two such places is a unit, whose ids do not depend on its
surroundings. A worker remembers the ids of units (by a 64-bit hash of their bytes, in
tables of fixed size) and asks the tokenizers library only for new ones; the rest is array
work over whole batches.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time (a longer text stands alone).
SLICE_BYTES = 1 << 20
#: New units that the library gets in one text.
TOGETHER = 400
#: The memory of units: sets of four, and the ids it may hold before it starts afresh.
SETS, WAYS, POOL_IDS = 1 << 18, 4, 1 << 23
#: Longer units are encoded each time.
LONGEST_BYTES = 256
END = "<|endoftext|>"


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def plain_ids(path: str, text: str) -> list[int]:
    """Ids as the library gives them for the whole text."""
    return tokenizer(path).encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=4)
def splits_words(path: str) -> bool:
    """Whether the vocabulary drops white space (ids at word ends), or keeps it as bytes."""
    return not plain_ids(path, " ")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of strings or binaries without nulls."""
    wide = column.type in (pa.large_string(), pa.large_binary())
    kind = np.dtype(np.int64 if wide else np.int32)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    body = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


@functools.lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _POWERS[name] = np.multiply.accumulate(values)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair, from one running sum. Modulo a power
    of two, so it tells short ranges apart (units of up to LONGEST_BYTES, a rolling window) but
    there are pairs of ranges from some 1,000 values on that agree: see ``words`` for those."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    found = (total[ends] - total[starts]) * down[starts]
    found ^= (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the parts between spaces, line breaks and text borders, and the
    first unit of each text."""
    gap = (data == 0x20) | (data == 0x0A)
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    here = ~gap
    before = np.concatenate([[True], gap])[: len(data)] | border[:-1]
    after = np.concatenate([gap[1:], [True]])[: len(data)] | border[1:]
    starts, ends = np.flatnonzero(here & before), np.flatnonzero(here & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for byte vocabularies: a unit begins with a text, or with a space that has a
    visible character on both sides (anything that may be Unicode white space counts as
    not visible)."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        seen = ((data > 0x20) & (data < 0x7F)) | (data >= 0x80)
        # First bytes of the code points that are white space beyond ASCII.
        lead2, lead3 = data == 0xC2, (data >= 0xE1) & (data <= 0xE3)
        left, right = seen.copy(), seen & ~lead2 & ~lead3
        left[1:] &= ~lead2[:-1]
        left[2:] &= ~lead3[:-2]
        cut[1 : n - 1] = (data[1:-1] == 0x20) & left[:-2] & right[2:]
        border = np.zeros(n + 2, bool)
        border[offsets] = True
        cut[:n] &= ~border[1 : n + 1]  # a space that ends a text
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    cut[full] = True
    starts = np.flatnonzero(cut[:n])
    ends = np.append(starts[1:], n) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, offsets)


class UnitMemory:
    """Ids of units that this worker has met, in tables of fixed size."""

    def __init__(self, path: str):
        self.path = path
        self.end_id = tokenizer(path).token_to_id(END)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros((WAYS, SETS), np.uint64)
        self.places = np.zeros((WAYS, SETS), np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 1  # place 0: no ids
        self.ends = np.zeros((WAYS, SETS), np.int32)

    @staticmethod
    def sets(hashes: np.ndarray) -> np.ndarray:
        """The lowest bit is always one (a key is never 0), so the set is taken from others."""
        return ((hashes >> np.uint64(1)) & np.uint64(SETS - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and end in the pool; place 0 where the unit is unknown."""
        place = self.sets(hashes)
        first, last = np.zeros(len(hashes), np.int32), np.zeros(len(hashes), np.int32)
        for way in range(WAYS):
            same = self.keys[way][place] == hashes
            hit = np.flatnonzero(same)
            at = place[hit]
            first[hit], last[hit] = self.places[way][at], self.ends[way][at]
        return first, last

    def learn(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode these units; their places in the pool."""
        simple = [i for i, u in enumerate(units) if "<|" not in u and "|>" not in u]
        lists: dict[int, np.ndarray] = {}
        groups = [simple[i : i + TOGETHER] for i in range(0, len(simple), TOGETHER)]
        coded = tokenizer(self.path).encode_batch_fast([END.join([units[i] for i in g]) for g in groups], add_special_tokens=False)
        first, last = np.zeros(len(units), np.int32), np.zeros(len(units), np.int32)
        for group, encoding in zip(groups, coded, strict=True):
            ids = np.array(encoding.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.end_id)
            assert len(cuts) == len(group) - 1
            base = self.put(ids)
            first[group] = base + np.concatenate([[0], cuts + 1])
            last[group] = base + np.append(cuts, len(ids))
        for i in set(range(len(units))) - set(simple) if len(simple) < len(units) else ():
            lists[i] = np.array(plain_ids(self.path, units[i]), np.uint32)
            first[i] = self.put(lists[i])
            last[i] = first[i] + len(lists[i])
        return first, last

    def put(self, ids: np.ndarray) -> int:
        base = self.used
        while base + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[base : base + len(ids)] = ids
        self.used += len(ids)
        return base

    def keep(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Remember distinct new units; the oldest of a full set gives way."""
        left = np.arange(len(hashes))
        place = self.sets(hashes)
        for way in range(WAYS):
            free = left[self.keys[way][place[left]] == 0] if way < WAYS - 1 else left
            _, one = np.unique(place[free], return_index=True)
            chosen = free[one]
            at = place[chosen]
            self.keys[way][at], self.places[way][at], self.ends[way][at] = hashes[chosen], first[chosen], last[chosen]
            left = np.setdiff1d(left, chosen, assume_unique=True)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text begins among them."""
        if self.used > POOL_IDS:
            self.forget()
        cut = word_units if splits_words(self.path) else byte_units
        starts, ends, of_text = cut(data, offsets)
        hashes = range_hashes(_byte_values()[data], starts, ends) | np.uint64(1)
        first, last = self.find(hashes)
        unknown = first == 0
        unknown |= ends - starts > LONGEST_BYTES
        if unknown.any():
            raw = data.tobytes()
            which = np.flatnonzero(unknown)
            distinct, one, back = np.unique(hashes[which], return_index=True, return_inverse=True)
            long = ends[which[one]] - starts[which[one]] > LONGEST_BYTES
            text = [raw[starts[i] : ends[i]].decode() for i in which[one].tolist()]
            new_first, new_last = self.learn(text)
            first[which], last[which] = new_first[back], new_last[back]
            self.keep(distinct[~long], new_first[~long], new_last[~long])
            for i in which[ends[which] - starts[which] > LONGEST_BYTES].tolist():
                one_first, one_last = self.learn([raw[starts[i] : ends[i]].decode()])
                first[i], last[i] = one_first[0], one_last[0]
        sizes = (last - first).astype(np.int64)
        ends_at = np.cumsum(sizes)
        begins = np.concatenate([[0], ends_at])
        order = np.arange(begins[-1]) + np.repeat(first - begins[:-1], sizes)
        return self.pool[order], begins[of_text]


@functools.lru_cache(maxsize=2)
def memory(path: str) -> UnitMemory:
    return UnitMemory(path)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``most`` bytes: first row, end row, bytes and offsets."""
    data, offsets = buffers(column)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def encoded(path: str, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows of a column of texts: first row, end row, all their ids (unsigned 32
    bits), and offsets of the rows among these."""
    known = memory(path)
    for start, end, data, offsets in slices(column):
        ids, at = known.encode(data, offsets)
        yield start, end, ids, at
