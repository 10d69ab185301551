"""Operators of the llm subpackage against brute force, libraries and DuckDB,
on the small tables plus odd rows (nulls, empty and long texts, repeats)."""

import base64
import collections
import hashlib
import itertools
import math
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
ODD = ["", "  ", " a", "a ", "a  b", "a \n b", "\n\n x", "\x01 a  b", "\x02a \x01 b\x02", "a <|endoftext|> b",
       "x<|endoftext|>y  <|endoftext|>  z", "it's  I'll  ok\u3000x", "日本語 テキスト", "İstanbul ΣΟΦΟΣ", "e\u0301le\u0301ve",
       "<|startoftext|> a", "a\t b", "aaaa" * 500, "²³ ½a", "word—dash w***"]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    text = d.orderBy("doc_id").first()["text"]
    odd = [(10_000 + i, t, "en", "src0", len(t)) for i, t in enumerate([*ODD, "long " + "w " * 20_000, text, text])]
    odd += [(10_001, ODD[1], "en", "src0", 2), (None, None, None, None, None), (None, "x", None, None, 1), (20_000, None, "fr", "s", 0)]
    # Extra columns whose names clash with results.
    return d.union(spark.createDataFrame(odd, d.schema)).withColumn("n_tokens", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("id", F.lit(2))


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_token_counts_equal_the_library(spark, docs, none):
    from skirmish.llm.tokens import count_tokens
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    text = [r["text"] or "" for r in docs.collect()]
    want = collections.Counter((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in text)
    got = rows(count_tokens(docs, path))
    assert collections.Counter((n, k) for _, n, k, _ in got) == want
    assert all(over == (k > 1024) for _, _, k, over in got)
    assert rows(count_tokens(none, path)) == []


def test_packing_holds_each_id_once(spark, docs, none):
    from skirmish.llm.packing import pack_documents
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    pieces = pack_documents(docs, path, with_ids=True).toPandas()
    want = collections.Counter(tuple(library.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in docs.collect())
    assert (pieces.ids_crc32 == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in pieces.ids]).all()
    named = pieces[pieces.doc_id.notna() & ~pieces.doc_id.isin([10_001])]  # one id, one document
    got = collections.Counter(tuple(itertools.chain(*g.sort_values("start").ids)) for _, g in named.groupby("doc_id"))
    assert not got - want and sum(got.values()) == sum(want.values()) - 4
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]]
        size = s.length.sum()
        assert size <= 2048 and size & (size - 1) == 0  # nothing is padded
    assert rows(pack_documents(none, path)) == []


def test_bm25_returns_the_most_alike_unused():
    from skirmish.llm.packing import Shard
    terms = np.array([1, 2, 3, 9, 8, 7, 1, 2, 4, 1, 5, 6])
    shard = Shard(terms, np.array([0, 3, 6, 9, 12]), 24)
    assert shard.neighbours(0, np.array([False, True, True, True])).tolist() == [2, 3]
    assert shard.neighbours(0, np.array([False, True, False, True])).tolist() == [3]


def test_packing_brings_copies_of_different_files_together(spark, tmp_path):
    from skirmish.llm.packing import pack_documents
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(rng.choice(words, 150)) for _ in range(120)]
    copies = [f"{t} tail{i}" for i, t in enumerate(texts)]
    order = rng.permutation(120).tolist()
    for name, part in (("a", list(enumerate(texts))), ("b", [(1000 + i, copies[i]) for i in order])):
        spark.createDataFrame(part, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    both = spark.read.parquet(f"{tmp_path}/a").unionByName(spark.read.parquet(f"{tmp_path}/b")).repartitionByRange(2, "doc_id")
    held = collections.defaultdict(set)
    for r in pack_documents(both, public_tokenizers.path("word_bpe_49k.json")).collect():
        held[r["doc_id"]].add(r["sequence_id"])
    together = sum(bool(held[i] & held[1000 + i]) for i in range(120))
    assert together > 60  # by slices: none, as the files lie in two partitions


def test_warc_round_trip_with_magic_in_payloads(spark):
    from skirmish.llm.warc import MAGIC, round_trip
    from skirmish.session import scratch_dir
    inner = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    odd = [(1, "u", "a" + MAGIC + "b"), (2, "u", inner), (3, "u", "x\r\n\r\n" + inner + "tail" + inner), (4, None, None),
           (5, "u\r\n" + MAGIC, ""), (6, "u", MAGIC), (7, "u", MAGIC * 3 + "Content-Length: 9\r\n\r\n"), (None, "u", "n"),
           (8, "ü", "ü" + MAGIC + "日本"), (9, "u", "n"), (9, "u", "n"), (10, "u", "z" * 300_000)]
    pages = spark.createDataFrame(odd, "page_id long, url string, html string")
    got = round_trip(pages.repartition(2), scratch_dir(spark, "w")).toPandas()
    assert got.digest_ok.all()
    want = collections.Counter((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode())
                               for p, h in ((p, (h or "").encode()) for p, _, h in odd))
    ids = [None if p != p else int(p) for p in got.page_id]
    assert collections.Counter(zip(ids, got.payload_bytes, got.payload_digest)) == want
    revisit = got[got.record_type == "revisit"]
    assert sorted((str(p), r) for p, r in zip(revisit.page_id, revisit.refers_to)) == [("4.0", 5.0), ("nan", 9.0)]
    assert rows(round_trip(pages.limit(0), scratch_dir(spark, "w"))) == []


def test_main_text(spark):
    from skirmish.llm.html_template import extract_main_text
    body = ("<!doctype html><html><head><title>T</title></head><body><header>site</header><div class='cookie-notice'>c</div>"
            "<div id=sidebar>side</div><main><h1>Title %d</h1><p>A &amp; %d <b>bold</b>\n and<br>break<p>B &eacute; %d</p>"
            "<ul><li>one %d<li>two %d</ul><form>Name <input></form><section class='comments'><p>nice!</p></section>"
            "<p>Share this page</p></main><footer>foot</footer><script>x='<p>no</p>'</script></body></html>")
    odd = [(i, f"http://h.x/{i}", body.replace("%d", str(i))) for i in range(8)]
    odd += [(100, None, None), (None, "", ""), (101, "q", "plain < 5 & more <b>x</b>"), (102, "q", "<" * 500 + "<a href='" * 500)]
    got = {r["page_id"]: r for r in extract_main_text(spark.createDataFrame(odd, "page_id long, url string, html string")).collect()}
    assert got[3]["text"] == "Title 3\nA & 3 bold and break\nB é 3\none 3\ntwo 3"  # the shared block is template
    assert got[100]["text"] == got[None]["text"] == "" and got[101]["text"] == "plain < 5 & more x"
    assert got[3]["n_chars"] == len(got[3]["text"])


def test_classes_must_nest():
    from skirmish.llm.html_template import template_places
    assert template_places([1, 5, 2, 5, 3], [[1, 2, 3]]) == {0, 2, 4}
    assert template_places([1, 7, 8, 7, 8, 2], [[1, 2], [7, 8]]) == {0, 1, 2, 3, 4, 5}
    assert template_places([1, 2, 7, 3, 8], [[1, 2, 3], [7, 8]]) == {0, 1, 3}  # overlap: the smaller one goes


def test_string_tiling(spark, docs, none):
    from skirmish.llm.decontaminate import decontaminate, tiles
    a, b = list(range(10)), list(range(10, 20))
    assert sorted(tiles(a + b, [*b, -1, *a], 5)) == [(0, 11, 10), (10, 0, 10)]
    assert tiles(a, a + a, 5) == [(0, 0, 10)] and tiles(a, a[:4], 5) == []
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    item = bench.orderBy("item_id").first()
    w = item["text"].split()
    planted = [(1, " x y ".join([" ".join(w[20:]), " ".join(w[10:20]), " ".join(w[:10])])), (2, item["text"].upper() * 50), (3, "clean")]
    mixed = docs.select("doc_id", "text").union(spark.createDataFrame([(30_000 + i, t) for i, t in planted], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in decontaminate(mixed, bench).collect()}
    assert got[30_001]["contaminated"] and got[30_002]["contaminated"] and not got[30_003]["contaminated"]
    assert item["item_id"] in [x["item"] for x in got[30_001]["leaks"]]
    # Brute force on whole items, and the benchmark in many blocks.
    norm = lambda t: " ".join(x for x in (y.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for y in (t or "").lower().split()) if x)
    items = [norm(r["text"]) for r in bench.collect()]
    whole = {r["doc_id"] for r in mixed.collect() if any(i in norm(r["text"]) for i in items)}
    flagged = {i for i, r in got.items() if r["contaminated"]}
    assert whole <= flagged
    small = decontaminate(mixed, bench, block_bytes=3000).where("contaminated").select("doc_id")
    assert {r["doc_id"] for r in small.collect()} == flagged
    assert rows(decontaminate(none, bench)) == [] and not any(r["contaminated"] for r in decontaminate(docs, bench.limit(0)).collect())


def brute_statistics(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    windows = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered, seen, dup = set(), set(), 0
    for i in range(len(w) - 4):
        if windows[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_rules(spark, docs, none):
    from skirmish.llm.quality_rules import quality_rules
    got = rows(quality_rules(docs))
    assert collections.Counter(r[1:6] for r in got) == collections.Counter(brute_statistics(r["text"]) for r in docs.collect())
    for _, n, _, _, _, repeats, failed, distance, kept in got:
        assert failed == (n < 10 or 100 * repeats > 20 * n) and (distance is None) == failed and not (failed and kept)
    clean = [(i, " ".join(f"{x}{'abcdefgh'[(i + x) % 8:]}" for x in range(40 + i % 50)), "en", "s") for i in range(150)]
    junk = [(1000, " ".join(["word***&&&"] + [f"w{x}***%%%" for x in range(80)]), "en", "s")]
    verdict = {r[0]: r[-1] for r in rows(quality_rules(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")))}
    assert not verdict[1000] and sum(verdict.values()) == 150
    assert rows(quality_rules(none)) == []


def test_moderate_symbol_junk_is_an_outlier(spark):
    from skirmish.llm.quality_rules import quality_rules
    rng = np.random.default_rng(2)

    def words(n):
        return ["".join(rng.choice(list("abcdefghij"), k)) for k in rng.integers(3, 9, n)]

    clean = [(i, " ".join(words(int(rng.integers(60, 200)))), "en", "s") for i in range(300)]
    junk = [(1000 + i, " | ".join(" ".join(words(4)) for _ in range(20)), "en", "s") for i in range(4)]
    got = rows(quality_rules(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")))
    kept = {r[0] for r in got if r[-1]}
    assert not any(i >= 1000 for i in kept) and len(kept) >= 297


def test_outliers_of_each_kind_at_each_share(spark):
    from skirmish.llm.quality_rules import quality_rules
    rng = np.random.default_rng(5)

    def words(n, low=3, high=9):
        return ["".join(rng.choice(list("abcdefghij"), k)) for k in rng.integers(low, high, n)]

    def lines(ws, n=8):
        return "\n".join(" ".join(ws[i:i + n]) for i in range(0, len(ws), n))

    def symbols():
        return lines(["".join("#" if rng.random() < 0.1 else c for c in w) for w in words(300)])

    def repeated_lines():
        return "\nadvert\n".join(lines(words(300)).split("\n"))

    def repeated_words():
        ws = words(300)
        ws[200:227] = ws[20:47]
        return lines(ws)

    kinds = {"symbols": symbols, "lines": repeated_lines, "words": repeated_words, "length": lambda: lines(words(300, 12, 18))}
    data = []
    for kind, junk in kinds.items():
        for percent in (5, 15, 24):
            n = round(120 * percent / (100 - percent))
            data += [(0, lines(words(int(rng.integers(200, 400)))), kind, str(percent)) for _ in range(120)]
            data += [(1, junk(), kind, str(percent)) for _ in range(n)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id long, junk long, text string, lang string, source string")
    got = quality_rules(df, id_col="id").join(df.select("id", "junk", "lang", "source"), "id").toPandas()
    assert not got.base_failed.any()
    assert not got[(got.junk == 1) & got.kept].groupby(["lang", "source"]).size().to_dict()
    assert (~got[got.junk == 0].kept).mean() <= 0.01


def test_mcd_equals_the_least_of_all_subsets(spark):
    from skirmish.llm.quality_rules import CONSISTENCY, GRID, H, P, TINY, floors, mcd, _quantiles, _spread
    rng = np.random.default_rng(11)
    noise = [0.0, 0.01, 0.02, 0.03]
    points = {}
    for g in "abc":
        x = rng.normal(0, 0.1, (12, P)) + [5, 0.3, 0.3, 0.3]
        x[:3] += [[3, 0, 0, 0], [0, 2, 2, 0], [0, 0, -2, 3]][:3]
        points[g] = np.floor(x * GRID + 0.5).astype(int)
    vectors = spark.createDataFrame([(g, *map(int, r), 1) for g, x in points.items() for r in x],
                                    "g string, x0 long, x1 long, x2 long, x3 long, w long")
    quantiles = _quantiles(vectors)
    least = floors(_spread(vectors, quantiles), noise)
    size = math.ceil(12 * H)
    squares = [(np.sort(abs(x - np.sort(x, 0)[5]), 0)[:size] ** 2).sum(0) for x in points.values()]
    np.testing.assert_allclose(least, np.maximum(np.maximum(np.sqrt(sum(squares) / (3 * size)) / GRID, noise), TINY))
    got = {r["g"]: r for r in mcd(vectors, noise).collect()}
    for g, x in points.items():
        best = None
        for some in itertools.combinations(range(12), size):
            y = x[list(some)] / GRID
            scatter = np.cov(y.T, bias=True) * CONSISTENCY + np.diag(np.square(least))
            det = np.linalg.det(scatter)
            if best is None or det < best[0]:
                best = det, y.mean(0), np.linalg.cholesky(scatter)
        np.testing.assert_allclose([got[g][f"m{i}"] for i in range(P)], best[1], atol=1e-9)
        np.testing.assert_allclose([[got[g][f"l{i}{j}"] if j <= i else 0 for j in range(P)] for i in range(P)], best[2], atol=1e-9)


def test_simhash_components(spark, docs, none):
    from skirmish.llm.simhash import fingerprint, simhash_components
    got = rows(simhash_components(docs))
    source = [(r["doc_id"], fingerprint((r["text"] or "").encode(), 3)) for r in docs.collect()]
    assert collections.Counter((i, f"{f:016x}") for i, f in source) == collections.Counter((i, f) for i, f, _ in got)
    fps = sorted({f for _, f in source})
    root = {f: f for f in fps}

    def top(f):
        return f if root[f] == f else top(root[f])

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 2:
            root[top(a)] = top(b)
    least = {}
    for i, f in source:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    assert all(c == least.get(top(int(f, 16))) for _, f, c in got)
    assert rows(simhash_components(none)) == []


def test_simhash_links_in_large_shards(spark, monkeypatch):
    """With tiny shards every link comes through the second cut."""
    from skirmish.llm import simhash
    monkeypatch.setattr(simhash, "SHARD", 2)
    fps = [0, 1, 3, 7, 1 << 40, (1 << 40) | (1 << 63), 0xFFFF, 0xFFFE, 0xFFF0FFFF, 5]
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    pairs = rows(simhash.links(spark.createDataFrame(signed, "fp long"), 2))
    parent = {f: f for f in fps}

    def top(x, parent):
        return x if parent[x] == x else top(parent[x], parent)

    for a, b in pairs:
        parent[top(a % (1 << 64), parent)] = top(b % (1 << 64), parent)
    brute = {f: f for f in fps}
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 2:
            brute[top(a, brute)] = top(b, brute)
    for a, b in itertools.combinations(fps, 2):
        assert (top(a, parent) == top(b, parent)) == (top(a, brute) == top(b, brute))


def test_quality_classifier_on_labels_it_has_not_seen(spark, none):
    from skirmish.llm.quality_classifier import quality_scores
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.where("crc32(cast(doc_id as string)) % 2 = 0")
    got = quality_scores(docs, seen).join(labels.join(seen, "doc_id", "left_anti"), "doc_id").toPandas()
    good = got[got.quality == 1]
    assert len(got) > 100 and good.kept.mean() >= 0.98 and (~got[got.quality == 0].kept).mean() >= 0.9
    empty = quality_scores(docs, labels.limit(0))
    assert empty.where("not kept").count() == 0
    assert rows(quality_scores(none, labels)) == []


def test_language_forward_sums_all_segmentations():
    from skirmish.llm.lang_id import forward, pieces
    vocab = pieces(public_tokenizers.path("piece_bpe_32k.model"))
    known = {p: i for i, p in enumerate(vocab.names)}
    rng = np.random.default_rng(0)
    table = rng.random((len(known) + 1, 2)) / 1000
    words = ["▁there", "▁été", "▁日本", "▁a", "▁donaudampfschifffahrtsgesellschaft", "▁" + "therein" * 40, "▁" + "x日ing" * 1100]
    got = forward(*vocab.lattice(words), table, vocab.longest)

    def brute(word, language):
        # Exact fractions have no least number.
        alpha = [Fraction(1)]
        for j in range(1, len(word) + 1):
            alpha.append(sum(alpha[j - l] * Fraction(table[known.get(word[j - l:j], len(known)), language])
                             for l in range(1, min(j, vocab.longest) + 1) if l == 1 or word[j - l:j] in known))
        return alpha[-1]

    for i, w in enumerate(words[:-1]):
        for language in (0, 1):
            want = brute(w, language)
            np.testing.assert_allclose(got[i, language], math.log(want.numerator) - math.log(want.denominator), rtol=1e-12)
    # A word over several blocks of positions: the ratio of two lengths is that of one more repetition.
    a, b, c = (forward(*vocab.lattice(["▁" + "x日ing" * n]), table, vocab.longest)[0] for n in (1098, 1099, 1100))
    np.testing.assert_allclose(c - b, b - a, rtol=1e-9)
    np.testing.assert_allclose(got[-1], c)


def test_words_are_scored_whole_in_any_company():
    from skirmish.llm.lang_id import pieces, word_scores
    vocab = pieces(public_tokenizers.path("piece_bpe_32k.model"))
    table = np.random.default_rng(1).random((len(vocab.names) + 1, 3)) / 1000
    words = ["", "a", "internationalisation" * 9, "b" * 70_000, *[f"word{i}" for i in range(9000)]]
    got = word_scores(words, vocab, table)
    assert not got[0].any()
    for i in (1, 2, 3, 4, 9003):
        np.testing.assert_allclose(got[i], word_scores([words[i]], vocab, table)[0])


def test_expected_counts_equal_the_listed_segmentations():
    from skirmish.llm.lang_id import expected, pieces
    vocab = pieces(public_tokenizers.path("piece_bpe_32k.model"))
    known = {p: i for i, p in enumerate(vocab.names)}
    table = np.random.default_rng(3).random((len(known) + 1, 2)) / 1000
    words, language, weight = ["▁there", "▁zählen"], np.array([0, 1]), np.array([2.0, 1.0])
    out = np.zeros(2 * len(table))
    expected(*vocab.lattice(words), table, language, weight, out)
    want = np.zeros_like(out)

    def cuts(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            at = known.get(word[:k], -1 if k == 1 else None)
            if at is not None:
                for rest in cuts(word[k:]):
                    yield [at, *rest]

    for w, lang, n in zip(words, language, weight):
        each = [(c, np.prod(table[c, lang])) for c in cuts(w)]
        total = sum(p for _, p in each)
        for c, p in each:
            for at in c:
                if at >= 0:
                    want[lang * len(table) + at] += n * p / total
    np.testing.assert_allclose(out, want, atol=1e-12)


def test_languages_of_held_out_rows(spark, docs, none):
    from skirmish.llm.lang_id import predict_languages
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = predict_languages(docs, path).toPandas()
    lang = {r["doc_id"]: r["lang"] for r in docs.collect() if r["doc_id"] is not None and r["doc_id"] < 10_000}
    held = got[got.held_out & got.doc_id.isin(list(lang))]
    assert len(held) > 30 and np.mean([lang[i] == p for i, p in zip(held.doc_id, held.lang_pred)]) > 0.97
    assert got.score.between(0, 1).all()
    assert set(got[got.doc_id.isin([10_000, 10_001, 20_000])].lang_pred) == {"und"}
    assert rows(predict_languages(none, path)) == []


def test_url_filter_equals_its_sql(spark, tmp_path):
    from skirmish.llm.queries import op10_bloom_url_filter
    from skirmish.llm.sql import OP10_SQL
    urls = ["http://www.spam-farm.example.com/en/1?utm_source=x#a", "https://m.spam-farm.example.com:443/en/1/", None, "", "no scheme",
            "http://EXAMPLE.org/es/1", "http://a.example.org/en/12", "http://example.org/en/2", "http://b.com/fr/x", "http://b.com/de/x",
            "http://notexample.org/es/", "ftp://x?q=1", "http://a://b/c", "http://c.net/a?b=2&a=1", "http://c.net/a?a=1&b=2", "http://x.net"]
    table = spark.createDataFrame([(i, u, "") for i, u in enumerate([*urls, urls[0]])] + [(None, urls[0], "")], "page_id long, url string, html string")
    table.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = rows(op10_bloom_url_filter(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert collections.Counter(got) == collections.Counter(con.sql(OP10_SQL).fetchall())


def test_url_filter_of_a_list_of_its_own(spark):
    from skirmish.llm.url_filter import LOAD, _word_and_mask, bloom, filter_urls
    listed = spark.createDataFrame([(f"http://h{i % 50}.net/p{i}/",) for i in range(6000)] + [(None,), ("no scheme",)], "url string")
    data = [(i, f"https://www.h{i % 50}.net/p{i}?utm_source=a", "x", "y", i) for i in range(0, 12_000, 3)]
    data += [(None, None, "x", "y", 0), (1, "", "x", "y", 0), (2, "http://h2.net/p2", "x", "y", 0), (2, "http://h2.net/p2", "x", "y", 0),
             (3, "http://" + "h" * 100_000 + "/x", "x", "y", 0)]
    # Extra columns whose names clash with results and helpers.
    df = spark.createDataFrame(data, "page_id long, url string, host string, key string, word long")
    want = collections.Counter()
    for i, u, *_ in data:
        known = bool(u) and (m := re.fullmatch(r"https?://(?:www\.)?h\d+\.net/p(\d+).*", u)) is not None and int(m[1]) < 6000
        want[i, "block" if known else "allow"] += 1
    for max_words in (1 << 21, 0):
        got = filter_urls(df, listed, rules=[], max_words=max_words)
        assert collections.Counter(rows(got.select("page_id", "verdict"))) == want
    # The share of possible hits among keys that are not listed does not grow with the list.
    for n in (100, 40_000):
        blocks = math.ceil(n / LOAD)
        word, mask = _word_and_mask(F.col("key"), blocks)
        words = bloom(spark.range(n).select(F.concat(F.lit("in"), "id").alias("key")), "key", blocks)
        other = spark.range(40_000).select(F.concat(F.lit("out"), "id").alias("key"))
        hits = other.select(word.alias("word"), mask.alias("mask")).join(words, "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        assert hits.count() < 0.015 * 40_000
    assert rows(filter_urls(df.limit(0), listed)) == []
    assert {r["verdict"] for r in filter_urls(df, listed.limit(0), rules=[]).collect()} == {"allow"}


def test_pipeline_keeps_columns_and_repeats_once(spark, docs, none):
    import corpus_pipeline
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, SF)
        if name != "packing":
            assert out.columns == docs.columns
            current = out
        assert rows(stage(spark, none, SF)) == []
    ids = [r["doc_id"] for r in current.collect()]
    assert len(ids) == len(set(ids)) and len(ids) > 100
    whole = collections.Counter(r["doc_id"] for r in out.where("start = 0").select("doc_id").distinct().collect())
    assert set(whole) == set(ids)


def test_pipeline_names_rows_by_all_that_a_verdict_needs(spark):
    import corpus_pipeline
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame([(1, "a", "en", "x"), (1, "a", "en", "y"), (1, "a", None, "x"), (None, None, None, None), (1, "a", "en", "x")], schema)
    named, row = corpus_pipeline._with_row(df)
    rejected = named.where("source = 'y' or source is null").select(row)
    assert sorted(rows(corpus_pipeline._without(named, row, rejected)), key=str) == [
        (1, "a", "en", "x"), (1, "a", "en", "x"), (1, "a", None, "x")]


def test_packing_search_scores_all_rows_of_a_common_word_exactly(spark):
    """Words in up to every row, over many more rows than any block, against BM25 by hand."""
    from skirmish.llm import neighbours as N
    rng = np.random.default_rng(5)
    texts = [" ".join(["all", *(f"c{x}" for x in rng.integers(0, 12, 8)), *(f"r{x}" for x in rng.integers(0, 300, 3))]) for _ in range(900)]
    texts += ["all " * 3, "", "alone", None, "Ünï, (c1) c1\nr2"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "c1 c2"), (900, "all c3")], "id long, text string")
    df = df.withColumn("node", N.node(F.col("text"))).withColumn("query", N.is_query(df, "id"))
    split = {r["node"]: [w for w in (x.strip("(),").lower() for x in (r["text"] or "").split()) if w] for r in df.collect()}
    every = [split[r["node"]] for r in df.collect()]
    n, mean = len(every), sum(map(len, every)) / len(every)
    count = collections.Counter(w for words in every for w in set(words))
    code = {w: int(N.words_of(pa.array([w]))[0][0]) for w in count}
    idf = {w: math.log1p((n - c + 0.5) / (c + 0.5)) for w, c in count.items()}
    look = {r["node"]: sorted((w for w in set(split[r["node"]]) if count[w] > 1), key=lambda w: (count[w], code[w]))[:24]
            for r in df.where("query").collect()}
    assert max(count.values()) > 900 and len(look) > 9
    got = N.gathered(df, 24).select("id", "node", "group", "score").collect()
    assert collections.Counter(r["id"] for r in got) == collections.Counter(r["id"] for r in df.collect())
    for r in got:
        words = split[r["node"]]
        tf, norm = collections.Counter(words), 1.2 * (0.25 + 0.75 * len(words) / mean)
        want = {q: sum(idf[w] * tf[w] * 2.2 / (tf[w] + norm) for w in ws if w in tf) for q, ws in look.items()}
        want = {q: s for q, s in want.items() if s}
        assert math.isclose(r["score"], max(want.values(), default=0))
        assert not want or math.isclose(want[r["group"]], r["score"])


def test_packing_deals_a_large_group_over_tasks_by_score(spark):
    from skirmish.llm import neighbours as N
    copies = [(i, "one two three four") for i in range(0, 30_000)] + [(100_000 + i, f"one two three x{i % 9} y{i}") for i in range(10_000)]
    df = spark.createDataFrame(copies, "id long, text string").repartition(4)
    df = df.withColumn("node", N.node(F.col("text"))).withColumn("query", N.is_query(df, "id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = N.gathered(df, 24).withColumn("task", F.spark_partition_id()).select("id", "task").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_task = collections.Counter(r["task"] for r in got)
    assert len(per_task) > 4 and max(per_task.values()) < 20_000
    assert sorted(r["id"] for r in got) == [i for i, _ in copies]
