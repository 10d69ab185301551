"""Operators 11 to 13 against brute force and DuckDB, with odd rows."""

import collections
import itertools
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return [tuple(r) for r in df.collect()]


def tops(links, n):
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[top(a)] = top(b)
    return [top(i) for i in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents of sf0.001, odd rows, and groups of near copies."""
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    first = d.orderBy("doc_id").first()["text"]
    rng = np.random.default_rng(3)
    odd = [None, "", " \t\n", "one", "ONE", "two words", "Two  Words", "three words here", "İ ß É", "w " * 30_000, first, first.upper()]
    base = [f"v{x}" for x in rng.integers(0, 400, 300)]
    near = []
    for _ in range(60):
        w = list(base)
        for at in rng.integers(0, 300, rng.integers(0, 8)):
            w[at] = f"z{rng.integers(0, 9999)}"
        near.append(" ".join(w))
    more = [(10_000 + i, t) for i, t in enumerate(odd + near)] + [(None, first), (None, "alone"), (10_003, "one")]
    return d.union(spark.createDataFrame(more, "doc_id long, text string")).withColumn("n_shingles", F.lit("x")).withColumn("word", F.lit(1))


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return frozenset(zip(w, w[1:], w[2:])) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def brute_links(sets, percent=90):
    out = set()
    for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
        if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
            k = len(a & b)
            if 100 * k >= percent * (len(a) + len(b) - k):
                out.add((i, j))
    return out


def test_jaccard_components(docs, none):
    from skirmish.llm.jaccard import jaccard_components
    source = [(r["doc_id"], shingle_set(r["text"])) for r in docs.collect()]
    distinct = sorted({s for _, s in source if s}, key=sorted)
    top = dict(zip(distinct, tops(brute_links(distinct), len(distinct))))
    least = {}
    for i, s in source:
        if s and i is not None:
            least[top[s]] = min(i, least.get(top[s], i))
    want = collections.Counter((i, len(s), least.get(top[s]) if s else i) for i, s in source)
    got = jaccard_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert collections.Counter(rows(got)) == want
    assert rows(jaccard_components(none)) == []


def test_jaccard_links_are_whole(docs, none, monkeypatch):
    """All links, with lists salted into parts of two entries and slices of a few texts."""
    from skirmish.llm import jaccard
    monkeypatch.setattr(jaccard, "SPLIT", 2)
    monkeypatch.setattr(jaccard, "SLICE", 5000)
    some = docs.where("doc_id >= 10000 or doc_id < 60")
    links, member = jaccard.jaccard_links(some)
    node_of = {}
    for (i, node, n), r in zip(sorted(rows(member), key=str), range(10**6)):
        node_of.setdefault(node, []).append((i, n))
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in some.where("doc_id is not null").collect()}
    named = {node: sets[next(i for i, _ in ids if i is not None)] for node, ids in node_of.items() if node is not None}
    order = list(named)
    want = {frozenset((order[i], order[j])) for i, j in brute_links([named[x] for x in order])}
    got = rows(links)
    assert {frozenset((a, b)) for a, b, _, _ in got} == want and len(got) == len(want) > 500
    assert all(len(named[a] & named[b]) == k and len(named[a] | named[b]) == u for a, b, k, u in got)
    assert all(len(n) == 0 or node is not None for node, n in node_of.items() if node is not None)


def test_shingles_of_sliced_arrays():
    from skirmish.llm.jaccard import shingle_hashes
    texts = pa.array([f"W{i} a b\tc d " + "x y z " * i for i in range(12)] + [None, "", "q"])
    whole, ends = shingle_hashes(texts, 3)
    for at, n in ((0, 15), (4, 5), (11, 4)):
        part, offsets = shingle_hashes(texts.slice(at, n), 3)
        assert (part == whole[ends[at]:ends[at + n]]).all() and (np.diff(offsets) == np.diff(ends[at:at + n + 1])).all()


def brute_negatives(table, every=50, n_pos=5, n_neg=3):
    out = []
    for a, la, va in table:
        if a % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in table if i != a and len(v) == len(va)),
                        key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in scored if r[2] == la][:n_pos]:
            near = [r for r in scored if r[2] != la and 50 * ps <= 100 * r[0] <= 95 * ps]
            out += [(a, p, k + 1, i, ps, s) for k, (s, i, _) in enumerate(near[:n_neg])]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    from skirmish.llm import hard_negatives as H
    rng = np.random.default_rng(5)
    odd = [(1, None, [1.0] * 4), (2, 1, None), (3, 1, [1.0, None, 0.0, 0.0]), (4, 1, [float("nan")] * 4), (5, 1, [float("inf"), 0.0, 0.0, 0.0]),
           (None, 1, [1.0] * 4), (50, 2, [0.0] * 4), (100, 2, [0.5, 0.5]), (101, 2, [0.5, 0.5]), (102, 3, [0.4, 0.5]), (150, 1, []), (151, 2, [])]
    many = [(1000 + i, int(rng.integers(0, 3)), (rng.integers(-3, 4, 4) / 2).tolist()) for i in range(400)]  # ties
    many += [(2000 + i, int(i % 2), [1.0, 0.5, 0.25, -1.0]) for i in range(60)]  # one vector
    many += many[:20]  # repeated rows
    df = spark.createDataFrame(odd + many, "vec_id long, label int, embedding array<double>").withColumn("rank", F.lit("x"))
    q = H.quantised(df, "vec_id", "embedding", "label", 256)
    table = sorted({(i, lab, tuple(int(np.floor(256 * x)) for x in v)) for i, lab, v in odd + many
                    if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    want = brute_negatives(table)
    assert sorted(rows(H.hard_negatives(q))) == want and len(want) > 100
    monkeypatch.setattr(H, "SHARD", 40)
    monkeypatch.setattr(H, "CHUNK", 3)
    monkeypatch.setattr(H, "DEPTH", 1)
    assert sorted(rows(H.hard_negatives(q))) == want
    assert rows(H.hard_negatives(q.limit(0))) == []


def test_the_threshold_stops_before_the_lists_end():
    from skirmish.llm.hard_negatives import Shard, _kth
    vectors = np.zeros((5000, 3), np.int64)
    vectors[:, 0] = np.arange(5000)
    shard = Shard(vectors, np.zeros(5000, np.int64))
    entries, scores = shard.search(np.array([2, 1, 0]), 0, True, lambda s: _kth(s, 3))
    assert sorted(scores)[-3:] == [9994, 9996, 9998] and len(entries) < 200
    assert set(entries) >= {4997, 4998, 4999}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_spelling(texts):
    counts = collections.Counter()
    for i, t in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                counts[w] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    near = {w: [x for x in counts if abs(len(x) - len(w)) <= 1 and one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def test_spelling_variants(spark, docs, none, monkeypatch):
    from skirmish.llm import spelling
    rng = np.random.default_rng(7)
    chain = " ".join(w for k, w in enumerate(["colour", "colours", "colourss", "xcolourss", "xcolorss"]) for _ in range(3 << k))
    short = [" ".join("".join(rng.choice(list("ab"), rng.integers(4, 9))) for _ in range(400)) for _ in range(6)]  # many edits at borders
    more = spark.createDataFrame([(30_000 + i, t) for i, t in enumerate([chain, "Éclair éclair " * 4, *short])] + [(None, "null null nullé nullé nullé")], "doc_id long, text string")
    both = docs.select("doc_id", "text").where("doc_id < 40 or doc_id >= 10000").union(more)
    want = brute_spelling([(r["doc_id"], r["text"]) for r in both.collect()])
    got = spelling.spelling_variants(both)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(rows(got)) == want
    roots = {r[0]: r[2] for r in want}
    assert roots["colour"] == "xcolorss"
    monkeypatch.setattr(spelling, "SPLIT", 2)
    assert sorted(rows(spelling.spelling_variants(both))) == want
    assert rows(spelling.spelling_variants(none)) == []


@pytest.mark.parametrize("name", ["op11_prefix_jaccard", "op12_hard_negatives", "op13_spelling_variants"])
def test_queries_equal_their_sql(spark, name):
    from skirmish.llm import queries
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(got.columns)
    want = found.fetchall()
    assert collections.Counter(tuple(r[n] for n in names) for r in got.collect()) == collections.Counter(want) and want
