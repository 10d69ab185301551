"""N-gram Jaccard join (operator 11): rare-first prefix filtering.

A text's set is its distinct word n-grams, as 64-bit hashes. Equal sets are one
node. All n-grams are brought into one order, rare ones first: by the count of
their bucket (a table of fixed size, counted over all texts), then by hash. Any
order gives right results; this one keeps the lists short. Two sets that reach
the threshold share an n-gram of their prefixes, so prefixes are joined, and a
pair goes on only past the length filter (sizes), the positional filter (what
can follow the shared n-gram) and the suffix filter. That one cuts the order of
hashes at fixed pivots into parts: where the sizes of two sets' parts differ,
the sets differ, and a pair with more differences than the threshold allows
goes. A set carries its sizes as odd or even, one bit a part. Each pair left is
verified once on both whole sets.

A list of the prefix join longer than ``SPLIT`` is salted: its entries are dealt
to so many parts and meet the whole list part by part. Where only components
are wanted, lists are first joined with two of their entries; what that puts
into one component needs no further pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.components import components
from skirmish.llm.storage import stored
from skirmish.llm.tokens import slices

BUCKET_BITS = 18  # buckets of the count table: 2 MB at any size of the corpus
PARTS = 512       # parts of the suffix filter in the lists, a multiple of 64
FINE = 4096       # parts of the suffix filter on pairs, for sets over ``PARTS``
SPLIT = 512       # entries of a list above which it is salted
ROUNDS = 2        # times that components are found along two entries of each list first
WORDS = 1 << 18   # 64-bit words of the filter of texts to fetch: 2 MB at any size of the corpus
SLICE = 4 << 20   # bytes of text held at once in a task

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * _M1
    h = (h ^ (h >> np.uint64(29))) * _M2
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): text i has the words ``hashes[offsets[i]:offsets[i+1]]``;
    A-Z lower-cased, words between ASCII white space."""
    words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(x.lower()) for x in names), np.uint64, len(names))
    index = coded.indices.to_numpy(zero_copy_only=False)
    word = np.fromiter(map(len, names), np.int64, len(names))[index] > 0
    return hashes[index[word]], np.r_[0, np.cumsum(word)][offsets - offsets[0]]


def shingle_hashes(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of all n-grams with repeats; a text with fewer words
    has its whole sequence as one, a text without words none."""
    h, offsets = word_hashes(texts)
    size = np.diff(offsets)
    n = np.where(size >= words, size - words + 1, np.minimum(size, 1))
    rolled = np.full(len(h), words, np.uint64)
    for j in range(words):
        rolled[:len(h) - j] = _mix(rolled[:len(h) - j] ^ h[j:])
    out_offsets = np.r_[0, np.cumsum(n)]
    at = np.repeat(offsets[:-1] - out_offsets[:-1], n) + np.arange(out_offsets[-1])
    out = rolled[at] if len(h) else h
    for i in np.flatnonzero((size > 0) & (size < words)):
        whole = np.array([size[i]], np.uint64)
        for x in h[offsets[i]:offsets[i + 1]]:
            whole = _mix(whole ^ x)
        out[out_offsets[i]] = whole[0]
    return out, out_offsets


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def bucket_counts(texts: DataFrame, words: int) -> np.ndarray:
    """N-grams per bucket over all texts: 2 ** ``BUCKET_BITS`` numbers."""

    def count(batches):
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, _ = shingle_hashes(part.column("text"), words)
                total += np.bincount(_bucket(h), minlength=len(total))
        found = np.flatnonzero(total)
        for i in range(0, len(found), 65536):
            at = found[i:i + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    sums = (texts.select("text").mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return counts


def overlap_of(n: int, percent: int) -> int:
    """Shared n-grams that a set of ``n`` needs with any partner."""
    return -(-percent * n // 100)


def _describe(texts: DataFrame, id_type: str, words: int, percent: int, counts: np.ndarray) -> DataFrame:
    """One row per text: id, text_hash, n, digest of the set (null if empty),
    parts (bit by bit, whether its size between two pivots is odd), fine (the
    same with more pivots, large sets only), prefix (rare first)."""

    def odd(s, n):
        return np.packbits(np.bincount((s >> np.uint64(32)).astype(np.int64) * n >> 32, minlength=n) & 1).view(np.int64)


    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, offsets = shingle_hashes(part.column("text"), words)
                size, digest, parts, fine, prefix = [], [], [], [], []
                for lo, hi in zip(offsets, offsets[1:]):
                    s = np.unique(h[lo:hi])
                    n = len(s)
                    size.append(n)
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()) if n else None)
                    parts.append(odd(s, PARTS))
                    fine.append(odd(s, FINE) if n > PARTS else None)
                    first = np.lexsort((s, counts[_bucket(s)]))[:n - overlap_of(n, percent) + 1] if n else []
                    prefix.append(s[first])
                ends = np.r_[0, np.cumsum([len(p) for p in prefix])].astype(np.int32)
                words_each = np.arange(0, (len(size) + 1) * (PARTS // 64), PARTS // 64, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text_hash"), pa.array(size, pa.int32()), pa.array(digest, pa.binary()),
                     pa.ListArray.from_arrays(words_each, pa.array(np.concatenate(parts))),
                     pa.array(fine, pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(prefix).view(np.int64)))],
                    names=["id", "text_hash", "n", "digest", "parts", "fine", "prefix"])

    return texts.mapInArrow(run, f"id {id_type}, text_hash long, n int, digest binary, parts array<long>, fine array<long>, prefix array<long>")


def _whole_sets(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and its whole set, computed again from the text of its row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, offsets = shingle_hashes(part.column("text"), words)
                sets = [np.unique(h[lo:hi]) for lo, hi in zip(offsets, offsets[1:])]
                ends = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["node", "grams"])

    rows = nodes.select("node", F.col("id").alias("node_id"), F.col("text_hash").alias("node_hash"))
    # A filter of fixed size passes the texts with a bit of a wanted hash; the join removes the rest.
    word, bit = F.pmod("text_hash", F.lit(WORDS)).cast("int"), F.pmod(F.shiftright("text_hash", 24), F.lit(64)).cast("int")
    marked = nodes.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("mark"))
    marked = marked.groupBy("word").agg(F.bit_or("mark").alias("marks"))
    texts = texts.withColumn("word", word).join(F.broadcast(marked), "word")
    texts = texts.where(F.call_function("getbit", F.col("marks"), bit) == 1).drop("word", "marks")
    own = texts.join(rows, texts.id.eqNullSafe(rows.node_id) & (texts.text_hash == rows.node_hash))
    found = own.select("node", "text").mapInArrow(run, "node long, grams array<long>")
    return found.groupBy("node").agg(F.first("grams").alias("grams"))  # rows given twice


def _joined(pairs: DataFrame, nodes: DataFrame, *cols: str) -> DataFrame:
    """Pairs (a, b) with the columns of both nodes, as a_<col> and b_<col>."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in cols]), side)
    return pairs


def _needed(n_a, n_b, percent: int):
    """Shared n-grams that two sets of these sizes need."""
    return F.ceil(F.lit(percent) * (n_a + n_b) / F.lit(100 + percent))


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that reach the threshold: suffix filter on the fine parts of
    large sets, then both whole sets."""
    sized = _joined(pairs, nodes, "n", "fine")
    differ = F.aggregate(F.zip_with("a_fine", "b_fine", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    allowed = F.col("a_n") + F.col("b_n") - 2 * _needed(F.col("a_n"), F.col("b_n"), percent)
    left = stored(sized.where(F.coalesce(differ <= allowed, F.lit(True))).select("a", "b"), "candidates")
    ends = left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct()
    sets = stored(_whole_sets(texts, nodes.join(ends, "node"), words), "sets")
    both = _joined(left, sets, "grams").withColumn("shared", F.size(F.array_intersect("a_grams", "b_grams")))
    union = F.size("a_grams") + F.size("b_grams") - F.col("shared")
    return (both.where(F.lit(100).cast("long") * F.col("shared") >= F.lit(percent).cast("long") * union)
            .select("a", "b", "shared", union.alias("union")))


def _passes(x: str, y: str, percent: int):
    """Length, positional and suffix filter on two entries of one list."""
    n_x, n_y = F.col(f"{x}.n"), F.col(f"{y}.n")
    needed = _needed(n_x, n_y, percent)
    rest = F.least(n_x - F.col(f"{x}.pos"), n_y - F.col(f"{y}.pos"))
    odd = [F.bit_count(F.col(f"{x}.parts")[i].bitwiseXOR(F.col(f"{y}.parts")[i])) for i in range(PARTS // 64)]
    differ = sum(odd[1:], odd[0])
    return (100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)) & (rest >= needed) & (differ <= n_x + n_y - 2 * needed)


def _pair(x: str, y: str):
    return [F.least(f"{x}.node", f"{y}.node").alias("a"), F.greatest(f"{x}.node", f"{y}.node").alias("b")]


def _star_pairs(entries: DataFrame, percent: int, seed: int) -> DataFrame:
    """The entries of each list and size class with two of them: the least and
    the greatest by a hash, so that a group's lists mostly agree on the two."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) if percent < 100 else 1))
    lists = entries.withColumn("band", band)
    entry = F.struct("n", "node", "pos", "comp", "parts")
    hub = F.struct(F.xxhash64("node", F.lit(seed)).alias("h"), entry.alias("y"))
    hubs = lists.groupBy("gram", "band").agg(F.min(hub).alias("lo"), F.max(hub).alias("hi")).where("lo.h <> hi.h")
    met = lists.join(hubs.select("gram", "band", F.explode(F.array("lo.y", "hi.y")).alias("y")), ["gram", "band"])
    met = met.select(entry.alias("x"), "y")
    return met.where((F.col("x.comp") != F.col("y.comp")) & _passes("x", "y", percent)).select(*_pair("x", "y")).distinct()


def _list_pairs(entries: DataFrame, percent: int, apart: bool) -> DataFrame:
    """All pairs of a list that pass the filters (``apart``: of two components
    only); a long list is dealt to parts by node, each meets all of it."""
    parts = F.ceil(F.col("size") / F.lit(SPLIT)).cast("int")
    entry = F.struct("n", "node", "pos", "comp", "parts")
    x = entries.select("gram", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), entry.alias("x"))
    y = entries.select("gram", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), entry.alias("y"))
    met = x.join(y, ["gram", "part"]).where((F.col("x.node") < F.col("y.node")) & _passes("x", "y", percent))
    if apart:
        met = met.where(F.col("x.comp") != F.col("y.comp"))
    return met.select(*_pair("x", "y")).distinct()


def _with_comp(df: DataFrame, root: DataFrame, node: str, comp: str) -> DataFrame:
    """``df`` with the root of its column ``node``: the node itself where it has none."""
    of = root.select(F.col("node").alias(node), F.col("root").alias(comp))
    return df.join(of, node, "left").withColumn(comp, F.coalesce(comp, node))


def _nodes(df: DataFrame, id_col: str, text_col: str, words: int, percent: int):
    """(texts, described rows, nodes, entries of the lists with two entries or more)."""
    texts = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    counts = bucket_counts(texts, words)
    rows = stored(_describe(texts, df.schema[id_col].dataType.simpleString(), words, percent, counts), "described")
    classes = (rows.where("n > 0").groupBy("digest")
               .agg(F.min("id").alias("least"), F.min(F.struct("id", "text_hash")).alias("row"), F.first("n").alias("n"),
                    F.first("parts").alias("parts"), F.first("fine").alias("fine"), F.first("prefix").alias("prefix")))
    nodes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "least", F.col("row.id").alias("id"),
                                  F.col("row.text_hash").alias("text_hash"), "n", "parts", "fine", "prefix"), "nodes")
    entries = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "gram"))
    shared = entries.groupBy("gram").agg(F.count("*").alias("size")).where("size > 1")
    return texts, rows, nodes, stored(entries.join(shared, "gram").join(nodes.select("node", "parts"), "node"), "entries")


def jaccard_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                  percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """The whole join: (links, membership).

    links: one row per pair of different sets that reach the threshold, once:
    a, b (node numbers), shared and union (sizes). membership: ``id_col``, node
    (null: empty set) and n_shingles of every row. Ids, nulls and repeats as in
    ``jaccard_components``.
    """
    texts, rows, nodes, entries = _nodes(df, id_col, text_col, words, percent)
    pairs = _list_pairs(entries.withColumn("comp", F.col("node")), percent, apart=False)
    links = stored(_verified(pairs, nodes, texts, words, percent), "links")
    member = rows.join(nodes.select("digest", "node"), "digest", "left")
    return links, member.select(F.col("id").alias(id_col), "node", F.col("n").cast("long").alias("n_shingles"))


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       percent: int = 90) -> DataFrame:
    """Components of all texts linked by n-gram Jaccard similarity.

    Texts are lower-cased in A-Z only and cut at ASCII white space; a set is
    its distinct n-grams of ``words`` words, of a shorter text its whole
    sequence. Linked are texts with 100 * intersection >= ``percent`` * union.

    Returns ``id_col``, n_shingles (size of the set) and component_id, the
    smallest id reachable over links. Null, empty and blank texts have an empty
    set, are linked with nothing and keep their own id; equal sets are linked
    whatever the number of copies; repeated rows are returned each; a null id
    gets its component's smallest known id, null if there is none. Texts are
    taken whole; other columns are not read; an empty table gives an empty
    result.
    """
    texts, rows, nodes, entries = _nodes(df, id_col, text_col, words, percent)
    root = None  # (node, root) of what is joined so far
    for seed in range(ROUNDS + 1):
        near = entries.withColumn("comp", F.col("node"))
        if root is not None:
            near = _with_comp(entries, root, "node", "comp")
            unlike = near.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
            near = near.join(unlike.select("gram"), "gram", "left_semi")
        pairs = _star_pairs(near, percent, seed) if seed < ROUNDS else _list_pairs(near, percent, apart=True)
        links = _verified(pairs, nodes, texts, words, percent).select("a", "b")
        if root is not None:  # links between the roots, and the roots' own nodes
            links = _with_comp(_with_comp(links, root, "a", "u"), root, "b", "v").select(F.col("u").alias("a"), F.col("v").alias("b"))
            links = links.union(root.select(F.col("node").alias("a"), F.col("root").alias("b")))
        root = components(stored(links, "links"), "a", "b")
    of = root.union(root.select(F.col("root").alias("node"), "root").distinct())
    least = of.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component"))
    known = nodes.join(of.join(least, "root"), "node", "left").select("digest", F.coalesce("component", "least").alias("component"))
    known = stored(known, "components")
    empty = F.col("digest").isNull()
    return (rows.where(~empty).join(known, "digest").select("id", "n", "component")
            .union(rows.where(empty).select("id", "n", "id"))
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id")))
