"""SimHash near-duplicates (operator 7) with sharded BK-trees.

A document's fingerprint is the bit-wise majority of its shingles' hashes.
Fingerprints within the radius r agree on at least two of r + 2 equal bit
blocks, so the shards are the pairs of blocks with their values: every link
lies inside a shard, and a shard of the distinct fingerprints stays small
however large the table is. Each shard becomes a BK-tree in the task that
holds it (a tree of all fingerprints would have to pass through the driver to
be broadcast), searched with its own fingerprints along the edges within the
radius. A shard that is still too large is cut once more by pairs of blocks of
its remaining bits, which bounds it by the number of values those bits have.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.components import components
from skirmish.llm.storage import stored

SHARD = 4096  # distinct fingerprints above which a shard is cut again


def fingerprint(text: bytes, words: int) -> int:
    """Unsigned 64-bit SimHash of a text: ASCII lower case, words between
    ASCII white space, shingles of ``words`` words with repeats."""
    found = text.lower().split()
    if not found:
        return 0
    join = b" ".join
    shingles = map(join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [join(found)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, 42) for s in shingles), np.uint64)
    bits = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        bits += np.unpackbits(h[i:i + 65536].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(h)).tobytes(), "big")


class BKTree:
    """Children keyed by their integer Hamming distance to the parent."""

    def __init__(self, values: np.ndarray):
        self.value = int(values[0])
        rest = values[1:]
        distance = np.bitwise_count(rest ^ values[0])
        self.children = {int(d): BKTree(rest[distance == d]) for d in np.unique(distance)}

    def search(self, queries: np.ndarray, radius: int, out: list) -> None:
        """Append (query, node value) for every link within the radius,
        following only edges that can hold one."""
        distance = np.bitwise_count(queries ^ np.uint64(self.value)).astype(np.int64)
        out += [(int(q), self.value) for q in queries[distance <= radius] if q != self.value]
        for edge, child in self.children.items():
            near = queries[np.abs(distance - edge) <= radius]
            if len(near):
                child.search(near, radius, out)


def forest(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The links that join parts not joined before: as many components, and
    fewer links than values."""
    parent: dict[int, int] = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in links:
        p, q = top(a), top(b)
        if p != q:
            parent[p] = q
            kept.append((a, b))
    return kept


def _blocks(first: int, width: int, n: int):
    """n adjoining bit ranges (shift, size) that cover ``width`` bits from ``first``."""
    edges = [first + width * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _bits(fp, shift, size):
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << size) - 1))


def _shard_keys(fp, blocks):
    """One key per pair of blocks: the pair's number and both values."""
    pairs = combinations(blocks, 2)
    return F.array(*[F.struct(F.lit(i).alias("pair"), _bits(fp, *a).alias("x"), _bits(fp, *b).alias("y"))
                     for i, (a, b) in enumerate(pairs)])


def _links(shards: DataFrame, radius: int) -> DataFrame:
    """Links between the distinct fingerprints of each shard, as a forest."""

    def search(batches):
        for batch in batches:
            a, b = [], []
            for values in batch.column("fps"):
                fps = values.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found: list[tuple[int, int]] = []
                BKTree(fps).search(fps, radius, found)
                for x, y in forest(found):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.uint64).view(np.int64)),
                                              pa.array(np.array(b, np.uint64).view(np.int64))], names=["a", "b"])

    return shards.select("fps").mapInArrow(search, "a long, b long")


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``id_col`` and fp (long, the fingerprint's 64 bits) of every row."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.array(found, np.uint64).view(np.int64))],
                                             names=[id_col, "fp"])

    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
            .mapInArrow(run, f"`{id_col}` {id_type}, fp long"))


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect what lies within ``radius`` bits, from a
    table of distinct fingerprints ``fp``."""
    blocks = _blocks(0, 64, radius + 2)
    keyed = distinct.select("fp", F.explode(_shard_keys(F.col("fp"), blocks)).alias("k"))
    sizes = keyed.groupBy("k").agg(F.count("*").alias("n"))
    large = stored(sizes.where(F.col("n") > SHARD).select("k"), "large-shards")
    small = (keyed.join(sizes.where((F.col("n") > 1) & (F.col("n") <= SHARD)).select("k"), "k")
             .groupBy("k").agg(F.collect_list("fp").alias("fps")))
    pairs = list(combinations(range(len(blocks)), 2))
    again = []
    for i, pair in enumerate(pairs):  # the bits outside the pair, as narrower blocks
        rest = [b for j, (lo, width) in enumerate(blocks) if j not in pair for b in _blocks(lo, width, 2)]
        again.append(F.when(F.col("k.pair") == i, _shard_keys(F.col("fp"), rest)))
    cut = (keyed.join(large, "k").select("fp", "k", F.explode(F.coalesce(*again)).alias("k2"))
           .groupBy("k", "k2").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))
    return _links(small.select("fps").union(cut.select("fps")), radius)


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       radius: int = 2) -> DataFrame:
    """Near-duplicate components of all documents by SimHash.

    Returns ``id_col``, fingerprint (16 hexadecimal digits) and component_id,
    the smallest id among all documents reachable over links of at most
    ``radius`` (2: blocks are pairs out of four) differing bits. Equal
    fingerprints are linked; null, empty and blank texts have fingerprint zero
    and are linked like any other; repeated rows are returned each; a null id
    gets its component's smallest known id, null if there is none; other
    columns are not read; an empty table gives an empty result.
    """
    marked = stored(fingerprints(df, id_col, text_col, words), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    root = components(links(distinct, radius), "a", "b")
    rooted = distinct.join(root, distinct.fp == root.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.join(root.select("root").distinct(), "root").groupBy("root").agg(F.min("least").alias("component"))
    joined = rooted.join(least, "root", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    return marked.join(joined, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
