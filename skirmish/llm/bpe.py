"""Byte-pair merging of many short symbol sequences at once, as numpy arrays.

A batch of pre-tokens is one flat symbol array plus segment ids. Each round
finds the lowest-rank adjacent pair of every live segment and merges all its
occurrences in all segments at the same time; a segment without a ranked pair
is finished. Rounds are bounded by the longest pre-token, and each costs time
linear in the symbols that are still live.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_NONE = np.int32(2**31 - 1)
_SHIFT = np.int64(20)
_CHUNK = 8192
_MET, _SHORT = 200_000, 32  # pre-tokens, and bytes of each, that a vocabulary remembers


class PairTable:
    """(left id, right id) -> (rank, merged id): open addressing in numpy."""

    def __init__(self, left, right, merged):
        key = (np.asarray(left, np.int64) << _SHIFT) | np.asarray(right, np.int64)
        key, first = np.unique(key, return_index=True)
        rank, merged = first.astype(np.int32), np.asarray(merged, np.int32)[first]
        bits = max(4, int(len(key) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, _NONE, np.int32)
        self.merged = np.zeros(1 << bits, np.int32)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            put, at = np.unique(slot[free], return_index=True)
            won = free[at]
            self.keys[put], self.rank[put], self.merged[put] = key[won], rank[won], merged[won]
            todo = np.setdiff1d(todo, won)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left, right):
        """Rank (``_NONE`` if the pair never merges) and merged id of each pair."""
        key = (left.astype(np.int64) << _SHIFT) | right
        slot = self._slot(key)
        found = self.keys[slot]
        rank = np.where(found == key, self.rank[slot], _NONE)
        merged = self.merged[slot]
        todo = np.flatnonzero((found != key) & (found != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            hit = todo[found == key[todo]]
            rank[hit], merged[hit] = self.rank[slot[hit]], self.merged[slot[hit]]
            todo = todo[(found != key[todo]) & (found != -1)]
        return rank, merged


def merge(symbols, lengths, table: PairTable):
    """Merge every segment to its end: the surviving symbols (flat) and their
    number per segment. ``symbols`` is flat, ``lengths`` gives the segments."""
    lengths = np.asarray(lengths, np.int64)
    n = len(lengths)
    seg = np.repeat(np.arange(n), lengths)
    sym = np.asarray(symbols, np.int32)
    done_sym, done_seg, done_pos = [], [], []
    rank = np.full(len(sym), _NONE, np.int32)
    made = np.zeros(len(sym), np.int32)
    if len(sym) > 1:
        inside = np.flatnonzero(seg[:-1] == seg[1:])
        rank[inside], made[inside] = table.find(sym[inside], sym[inside + 1])
    while len(sym):
        starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
        sizes = np.diff(np.r_[starts, len(seg)])
        least = np.minimum.reduceat(rank, starts)
        live = least != _NONE
        if not live.all():
            keep = np.repeat(live, sizes)
            done_sym.append(sym[~keep])
            done_seg.append(seg[~keep])
            sym, seg, rank, made = sym[keep], seg[keep], rank[keep], made[keep]
            least, sizes = least[live], sizes[live]
            if not len(sym):
                break
        at = np.flatnonzero(rank == np.repeat(least, sizes))
        # A run of overlapping occurrences (a a a) merges left to right: every other one.
        if len(at) > 1:
            new_run = np.r_[True, (np.diff(at) != 1)]
            first = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
        sym[at] = made[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        new = np.cumsum(keep) - 1
        sym, seg, rank, made = sym[keep], seg[keep], rank[keep], made[keep]
        at = new[at]
        changed = np.zeros(len(sym) + 1, bool)
        changed[at] = changed[at - 1] = True  # position -1 is the spare last one
        touched = np.flatnonzero(changed[:-1])
        rank[touched] = _NONE
        inner = touched[:-1] if len(touched) and touched[-1] == len(sym) - 1 else touched
        inner = inner[seg[inner] == seg[inner + 1]]
        rank[inner], made[inner] = table.find(sym[inner], sym[inner + 1])
    sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int32)
    seg = np.concatenate(done_seg) if done_seg else np.zeros(0, np.int64)
    order = np.argsort(seg, kind="stable")
    return sym[order], np.bincount(seg, minlength=n)


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte:
    printable Latin-1 characters stand for themselves, the others are moved to
    code points from 256 on, in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


class Vocabulary:
    """A byte-level BPE vocabulary file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.table = PairTable([ids[a] for a, _ in pairs], [ids[b] for _, b in pairs],
                               [ids[a.removesuffix(self.suffix) + b] if self.suffix else ids[a + b] for a, b in pairs])
        letters = byte_letters()
        self.start = np.array([ids[letters[b]] for b in range(256)], np.int32)
        self.end = np.array([ids[letters[b] + self.suffix] for b in range(256)], np.int32)
        self.met, self.met_ids, self.met_counts = pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, words: pa.Array):
        """Ids (flat) and their number for each of the distinct pre-tokens; an
        empty one has none. The first ``_MET`` short ones met are remembered."""
        at = pc.index_in(words, value_set=self.met).fill_null(-1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(at < 0)
        fresh = words.take(pa.array(new))
        ids, counts = self._merged(fresh)
        all_counts = np.r_[self.met_counts, counts]
        begin = np.cumsum(all_counts) - all_counts
        at = at.astype(np.int64)
        at[new] = len(self.met) + np.arange(len(new))
        flat = np.r_[self.met_ids, ids]
        size = all_counts[at]
        ends = np.cumsum(size)
        out = flat[np.repeat(begin[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        short = np.flatnonzero(pc.less_equal(pc.binary_length(fresh), _SHORT).to_numpy(zero_copy_only=False))
        short = short[:max(_MET - len(self.met), 0)]
        if len(short):
            self.met = pa.concat_arrays([self.met, fresh.take(pa.array(short))])
            kept = np.zeros(len(new), bool)
            kept[short] = True
            self.met_ids = np.r_[self.met_ids, ids[np.repeat(kept, counts)]]
            self.met_counts = np.r_[self.met_counts, counts[kept]]
        return out, size

    def _merged(self, words: pa.Array):
        if len(words) > _CHUNK:  # working arrays that stay in the processor's cache
            parts = [self._merged(words.slice(i, _CHUNK)) for i in range(0, len(words), _CHUNK)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        lengths = np.diff(offsets)
        raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(words) else np.zeros(0, np.uint8)
        sym = self.start[raw]
        last = np.cumsum(lengths)[lengths > 0] - 1
        sym[last] = self.end[raw[last]]
        return merge(sym, lengths, self.table)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process and file."""
    return Vocabulary(path)
