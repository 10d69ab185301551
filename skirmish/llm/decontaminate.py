"""Benchmark decontamination (operator 5): greedy string tiling.

The benchmark's word sequences go to the tasks in blocks of bounded size, and
each block is searched in one narrow pass over the documents, so nothing is
shuffled. Seeds, runs of ``MIN_MATCH`` words shared by a document and a test
item, are joined by hash over a whole slice of documents at once. For each
pair with a seed, greedy string tiling marks the longest matches that do not
overlap, again and again, by running Karp-Rabin; a test item is leaked if the
tiles cover enough of it, in whatever order they stand.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.tokens import slices

MIN_MATCH = 5  # words of the shortest tile
COVERAGE = 0.5  # share of a test item's words in tiles that makes it leaked
BLOCK_BYTES = 32 << 20  # benchmark text sent to the tasks at once
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BASE, _MOD = 1_000_003, (1 << 61) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array):
    """Distinct words (lower case, without punctuation around them), the word
    of each position and the texts' offsets; bare punctuation is no word."""
    cut = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = cut.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    cores = pc.utf8_lower(pc.utf8_trim(coded.dictionary, characters=_EDGE)).dictionary_encode()
    of = cores.indices.to_numpy(zero_copy_only=False).astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
    words = cores.dictionary.to_pylist()
    kept = ~np.isin(of, [i for i, w in enumerate(words) if not w])
    return words, of[kept], np.r_[0, np.cumsum(kept)][offsets - offsets[0]]


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` ids, by start."""
    if len(ids) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(ids) - size + 1, np.uint64)
    for k in range(size):
        part = ids[k:k + len(out)].astype(np.uint64) + np.uint64(1)
        out = (out ^ (part * _MIX)) * np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(29)
    return out


def tiles(pattern: list[int], text: list[int], least: int, first: int = 20) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (pattern start, text start, length) of the marked
    matches of at least ``least`` words; equal lengths by pattern start, then
    text start. Negative text ids match nothing."""
    used_p, used_t, found = [False] * len(pattern), [t < 0 for t in text], []
    size = max(first, least)
    while True:
        matches, longest = _scan(pattern, text, used_p, used_t, size)
        if longest > 2 * size:
            size = longest  # a very long match: search for its like first
            continue
        matches.sort(key=lambda m: (-m[2], m[0], m[1]))
        for p, t, n in matches:
            # What an earlier tile has taken cuts a match; its free part of full size is found again by the next scan.
            if not (any(used_p[p:p + n]) or any(used_t[t:t + n])):
                used_p[p:p + n], used_t[t:t + n] = [True] * n, [True] * n
                found.append((p, t, n))
        if matches:
            continue
        if size == least:
            return found
        size = max(least, size // 2)


def _scan(pattern, text, used_p, used_t, size):
    """Maximal unmarked matches of at least ``size`` words that start at an
    unmarked pair, by rolling hash; and the longest length."""
    at = defaultdict(list)
    for t, h in _rolling(text, used_t, size):
        at[h].append(t)
    matches, longest = [], 0
    for p, h in _rolling(pattern, used_p, size):
        for t in at.get(h, ()):
            if p and t and pattern[p - 1] == text[t - 1] and not used_p[p - 1] and not used_t[t - 1]:
                continue  # part of the match one word earlier
            n = 0
            while (p + n < len(pattern) and t + n < len(text) and pattern[p + n] == text[t + n]
                   and not used_p[p + n] and not used_t[t + n]):
                n += 1
            if n >= size:
                matches.append((p, t, n))
                longest = max(longest, n)
    return matches, longest


def _rolling(ids, used, size):
    """(start, Karp-Rabin hash) of every run of ``size`` unmarked ids."""
    h, run, top = 0, 0, pow(_BASE, size, _MOD)
    for i, x in enumerate(ids):
        if used[i]:
            h = run = 0
            continue
        h, run = (h * _BASE + x + 1) % _MOD, run + 1
        if run > size:
            h = (h - (ids[i - size] + 1) * top) % _MOD
        if run >= size:
            yield i - size + 1, h


class Block:
    """Part of a benchmark: its words, word sequences and seeds."""

    def __init__(self, names: list, texts: list[str | None]):
        words, of, offsets = words_of(pa.array(texts, pa.string()))
        self.number = {w: i for i, w in enumerate(words) if w}
        self.names, self.items, seeds = [], [], defaultdict(list)
        for name, lo, hi in zip(names, offsets[:-1], offsets[1:]):
            if hi > lo:
                item = of[lo:hi]
                size = min(MIN_MATCH, len(item))  # a shorter item matches whole
                seeds[size] += [(int(h), len(self.items), p) for p, h in enumerate(window_hashes(item, size))]
                self.names.append(name)
                self.items.append(item.tolist())
        self.seeds = {}
        for size, found in seeds.items():
            found.sort()
            hashes = np.array([h for h, _, _ in found], np.uint64)
            self.seeds[size] = hashes, np.array([i for _, i, _ in found]), np.unique(hashes)

    def leaks(self, texts: pa.Array, coverage: float) -> dict[int, list[tuple]]:
        """Text number -> (item name, coverage, tiles) of its leaked items."""
        words, of, offsets = words_of(texts)
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))[of]
        ends = np.repeat(offsets[1:], np.diff(offsets))
        touched: dict[tuple[int, int], list] = defaultdict(list)
        for size, (hashes, items, distinct) in self.seeds.items():
            known = np.r_[0, np.cumsum(ids >= 0)]
            start = np.flatnonzero(known[size:] - known[:len(known) - size] == size) if len(ids) >= size else np.zeros(0, int)
            start = start[start + size <= ends[start]]
            h = window_hashes(ids, size)[start] if len(start) else np.zeros(0, np.uint64)
            hit = np.isin(h, distinct)
            start, h = start[hit], h[hit]
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            doc = np.searchsorted(offsets, start, side="right") - 1
            for s, d, a, b in zip(start.tolist(), doc.tolist(), lo.tolist(), hi.tolist()):
                for item in set(items[a:b].tolist()):
                    touched[d, item].append((s, size))
        out: dict[int, list[tuple]] = defaultdict(list)
        for (doc, item), hits in sorted(touched.items()):
            # Tiles lie on seeds: only the words under them, the gaps as one foreign word.
            text, last = [], -1
            for s, size in hits:
                if s > last and text:
                    text.append(-1)
                text += ids[max(s, last):s + size].tolist()
                last = max(last, s + size)
            pattern = self.items[item]
            found = tiles(pattern, text, min(MIN_MATCH, len(pattern)))
            share = sum(n for _, _, n in found) / len(pattern)
            if share >= coverage:
                out[doc].append((self.names[item], share, len(found)))
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES):
    """The benchmark in parts of about ``block_bytes``, one in memory at a time."""
    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // block_bytes) + 1
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i) if n > 1 else rows
        found = part.orderBy("item", "text").collect()
        yield Block([r["item"] for r in found], [r["text"] for r in found])


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", coverage: float = COVERAGE,
                  block_bytes: int = BLOCK_BYTES, with_text: bool = False) -> DataFrame:
    """Leaked test items of every document.

    Returns ``id_col``, contaminated (any item leaked), coverage (the largest,
    0 if none is leaked), leaks (array of item, coverage, tiles; by item within
    a block); ``with_text`` adds the text as column text. A null or empty text or test item matches nothing; repeated rows
    are judged each, null ids stay null; an item given twice is reported
    twice; items shorter than ``MIN_MATCH`` words must stand whole; other
    columns are not read; an empty table gives an empty result.
    """
    item_type = benchmark.schema[item_col].dataType.simpleString()
    leak = f"array<struct<item: {item_type}, coverage: double, tiles: int>>"
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                     F.array().cast(leak).alias("leaks"))
    id_type = df.schema[id_col].dataType.simpleString()
    searches = blocks(benchmark, item_col, item_text, block_bytes)
    block = next(searches)
    while block:
        following = next(searches, None)
        more = bool(following) or with_text  # else the last pass has no more use for the texts
        schema = f"id {id_type}, " + ("text string, " if more else "") + f"leaks {leak}"
        rows, block = _search(rows, block, coverage, schema, "text" if more else None), following
    return rows.select(F.col("id").alias(id_col), (F.size("leaks") > 0).alias("contaminated"),
                       F.coalesce(F.array_max("leaks.coverage"), F.lit(0.0)).alias("coverage"), "leaks",
                       *["text"] * with_text)


def _search(rows: DataFrame, block: Block, coverage: float, schema: str, text: str | None) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)  # of bounded size, see ``blocks``

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                leaks = part.column("leaks")
                found = shared.value.leaks(part.column("text"), coverage)
                if found:
                    each = leaks.to_pylist()
                    for i, more in found.items():
                        each[i] = each[i] + [dict(zip(("item", "coverage", "tiles"), m)) for m in more]
                    leaks = pa.array(each, leaks.type)
                out = {"id": part.column("id"), **({text: part.column(text)} if text else {}), "leaks": leaks}
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return rows.mapInArrow(run, schema)
