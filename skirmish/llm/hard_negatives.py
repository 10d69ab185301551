"""Hard negatives (operator 12): Fagin's threshold algorithm.

Rows lie in shards of about ``SHARD``; a shard holds, for every dimension, its
rows sorted by that component. An anchor reads each list from the end its own
component's sign asks for (sorted access), scores every row it meets for the
first time with all its components (random access, integers), and stops once
the threshold, the score a row could still have that no list has shown, falls
strictly below the last score it needs: ties are met before it stops.

Two passes over the shards: an anchor's first positives, then, for the score
window below each of them, its first negatives. A shard gives its own first
rows, and the first of all shards are the answer, so nothing is lost by
sharding. Anchors visit the shards in chunks; neither side of a task grows with
the table. Rows of equal vector and label are one entry with its first ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skirmish.llm.storage import stored

SHARD = 4096  # entries of a shard, about
CHUNK = 4096  # anchors of a chunk, about
DEPTH = 32    # entries read from each list before the threshold is first looked at; fourfold each time after


class Shard:
    """The sorted lists of one shard. ``vectors``: one row per entry, long."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray):
        self.labels = labels
        self.n, self.dims = vectors.shape
        largest = int(np.abs(vectors).max(initial=0))
        # Integers below 2 ** 53 are exact in doubles, which multiply faster.
        self.exact = float(largest) ** 2 * max(1, self.dims) < 2.0 ** 52
        self.vectors = vectors.astype(np.float64) if self.exact else vectors
        self.largest = largest
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def _depths(self):
        depth, done = DEPTH, 0
        while done < self.n:
            depth = min(depth, self.n)
            yield done, depth
            done, depth = depth, depth * 4

    def search(self, anchor: np.ndarray, label: int, same: bool, needs):
        """(entries, scores) among which the first rows are: of the anchor's
        label or of others. ``needs(scores)`` is the least score still needed,
        given the scores met so far; rows below it may be missing."""
        exact = self.exact and float(np.abs(anchor).max(initial=0)) * max(1, self.largest) * max(1, self.dims) < 2.0 ** 52
        vectors = self.vectors if exact else self.vectors.astype(np.int64)
        a = anchor.astype(vectors.dtype)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        wanted = (self.labels == label) == same
        fresh = wanted.copy()  # not met yet
        entries, scores = [np.empty(0, np.int64)], [np.empty(0, vectors.dtype)]
        left = int(wanted.sum())
        if not len(up) and not len(down):
            met = np.flatnonzero(wanted)
            return met, np.zeros(len(met), np.int64)
        for lo, hi in self._depths():
            if not left:
                break
            mark = np.zeros(self.n, bool)
            mark[self.order[self.n - hi:self.n - lo, up].ravel()] = True
            mark[self.order[lo:hi, down].ravel()] = True
            met = np.flatnonzero(mark & fresh)
            fresh[met] = False
            left -= len(met)
            entries.append(met)
            scores.append(vectors[met] @ a)
            if hi < self.n:
                last = np.zeros(self.dims, vectors.dtype)
                last[up], last[down] = self.sorted[self.n - hi, up], self.sorted[hi - 1, down]
                if last @ a < needs(np.concatenate(scores)):
                    break
        return np.concatenate(entries), np.concatenate(scores).astype(np.int64)


def _kth(scores: np.ndarray, k: int):
    """The k-th largest score; without so many, less than any."""
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def window_of(positive: int) -> tuple[int, int]:
    """Least and greatest score s with 50 * positive <= 100 * s <= 95 * positive."""
    return -(-positive // 2), 95 * positive // 100


def _first(entries, scores, ids, k: int, not_id=None):
    """The first k (score, id): higher scores, then smaller ids."""
    if len(scores) > k:
        keep = scores >= _kth(scores, k + (not_id is not None)) if len(scores) > k + 1 else np.ones(len(scores), bool)
        entries, scores = entries[keep], scores[keep]
    rows = [(int(s), i) for e, s in zip(entries, scores) for i in ids[e] if i != not_id]
    return sorted(rows, key=lambda r: (-r[0], r[1]))[:k]


def _matrix(column, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), dims)


def _shard_of(table: pa.Table) -> tuple[Shard, list]:
    dims = table.column("dims")[0].as_py()
    vectors = _matrix(table.column("vector"), dims)
    return Shard(vectors, table.column("label").to_numpy()), table.column("ids").to_pylist()


def _positives(k: int):
    def run(shards: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if shards.num_rows and anchors.num_rows:
            shard, ids = _shard_of(shards)
            for row, name, label, a in zip(anchors.column("row").to_pylist(), anchors.column("anchor_id").to_pylist(),
                                           anchors.column("label").to_pylist(), _matrix(anchors.column("vector"), shard.dims)):
                # The anchor itself may be among the first: one more is needed.
                entries, scores = shard.search(a, label, True, lambda s: _kth(s, k + 1))
                out += [(row, name, i, s) for s, i in _first(entries, scores, ids, k, not_id=name)]
        return _table(out, ["row", "anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(k: int):
    def run(shards: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if shards.num_rows and anchors.num_rows:
            shard, ids = _shard_of(shards)
            for row, label, positives, a in zip(anchors.column("row").to_pylist(), anchors.column("label").to_pylist(),
                                                anchors.column("positives").to_pylist(), _matrix(anchors.column("vector"), shard.dims)):
                windows = sorted({w for w in map(window_of, positives) if w[0] <= w[1]})
                if not windows:
                    continue

                def needs(s, windows=windows):
                    return min(max(lo, _kth(s[(s >= lo) & (s <= hi)], k)) for lo, hi in windows)

                entries, scores = shard.search(a, label, False, needs)
                for lo, hi in windows:
                    inside = (scores >= lo) & (scores <= hi)
                    out += [(row, lo, hi, i, s) for s, i in _first(entries[inside], scores[inside], ids, k)]
        return _table(out, ["row", "lo", "hi", "negative_id", "negative_score"])
    return run


def _table(rows: list, names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def quantised(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """id, label, vector (array of long: floor(scale * x)) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                    F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")).alias("vector")))


def _best(df: DataFrame, group: list[str], score: str, tie: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(score), F.asc(tie)))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3) -> DataFrame:
    """Hard negatives of the anchors of ``rows`` (id, label: long, vector: array of long).

    Anchors are the rows whose id is divisible by ``every``. A row's score is
    its integer inner product with the anchor; higher scores come first, ties by
    the smaller id. Returns, for each anchor and each of its first ``positives``
    rows of the same label and another id, the first ``negatives`` rows of other
    labels with 50 * positive_score <= 100 * negative_score <= 95 *
    positive_score: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    Rows equal in id, label and vector count once. Rows of one id but different
    content are rows of their own; anchors of one id are searched each. Only
    vectors of the same length have a score. Scores must fit a long. An empty
    table gives an empty result.
    """
    rows = rows.where(F.col("id").isNotNull()).distinct().withColumn("dims", F.size("vector"))
    per = max(positives + 1, negatives)
    # Of equal vectors and labels only the first ids can be among the first rows.
    first = F.row_number().over(Window.partitionBy("dims", "label", "vector").orderBy("id"))
    entries = stored(rows.withColumn("first", first).where(F.col("first") <= per)
                     .groupBy("dims", "label", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    anchors = stored(rows.where(F.col("id") % every == 0)
                     .select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("anchor_id"), "label", "vector", "dims"),
                     "anchors")
    n_shards = max(1, -(-entries.count() // SHARD))
    n_chunks = max(1, -(-anchors.count() // CHUNK))
    shard = F.pmod(F.xxhash64("vector", "label"), F.lit(n_shards)).cast("int")
    chunk = F.pmod(F.xxhash64("row"), F.lit(n_chunks)).cast("int")
    key = ["dims", "shard", "chunk"]
    shards = (entries.withColumn("shard", shard)
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))).groupBy(*key))

    def visits(a: DataFrame):
        return (a.withColumn("chunk", chunk)
                .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).groupBy(*key))

    names = ["row", "anchor_id", "positive_id", "positive_score"]
    found = shards.cogroup(visits(anchors)).applyInArrow(_positives(positives), _schema(names))
    best = stored(_best(found, ["row"], "positive_score", "positive_id", positives).drop("rank"), "positives")

    scores = best.groupBy("row").agg(F.collect_list("positive_score").alias("positives"))
    names = ["row", "lo", "hi", "negative_id", "negative_score"]
    found = shards.cogroup(visits(anchors.join(scores, "row"))).applyInArrow(_negatives(negatives), _schema(names))
    near = _best(found, ["row", "lo", "hi"], "negative_score", "negative_id", negatives)
    # The window of a positive score, as ``window_of``.
    windowed = best.selectExpr("*", "(positive_score + pmod(positive_score, 2L)) div 2 AS lo",
                               "(95 * positive_score - pmod(95 * positive_score, 100L)) div 100 AS hi")
    return (windowed.join(near, ["row", "lo", "hi"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
