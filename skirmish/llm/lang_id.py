"""Language ID (operator 9): segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's likelihood is the sum over all ways to cut it into pieces, found by
the forward algorithm over the whole word, however long, whose probabilities
are rescaled on the way; a text's is the product over its words. Pieces never
span words, so words are scored once per slice of a partition, many at a time
as numpy arrays, and a text sums over its words. The probabilities come from
expectation maximisation (forward-backward) over the word counts of a bounded
sample, the expected piece counts being summed by a grouped aggregation.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.storage import stored
from skirmish.llm.tokens import slices

FIT_DOCS = 2_000  # expected documents per language in the sample
ROUNDS = 3  # of expectation maximisation
UNKNOWN = 1e-8  # probability of a letter that is no piece
FIT_WORD = 1_024  # code points; longer words of the sample are not learned from (all words are scored whole)
START = "▁"  # stands before a word in the vocabulary
_BASE = np.uint64(0x9E3779B97F4A7C15)
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"
_CELLS = 1 << 17  # words times longest word of one chunk
_BLOCK = 4096  # positions whose pieces are looked up at a time
_RESCALE = 8  # positions between two rescalings; no table holds less than 1e-20


class Pieces:
    """The vocabulary's pieces of one word, found by hash."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [model.id_to_piece(i) for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
        self.names = sorted({p for p in usable if START not in p[1:]})
        self.longest = max(map(len, self.names))
        codes, lengths = _codes(self.names)
        at = np.r_[0, np.cumsum(lengths)]
        h = np.zeros(len(self.names), np.uint64)
        for j in range(self.longest):
            inside = np.flatnonzero(lengths > j)
            h[inside] = h[inside] * _BASE + codes[at[inside] + j]
        h ^= lengths.astype(np.uint64)
        order = np.argsort(h)
        self.hashes, self.order = h[order], order
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self._low(h)] = True

    @staticmethod
    def _low(h):
        return ((h ^ (h >> np.uint64(29))) & np.uint64((1 << 22) - 1)).astype(np.int64)

    def find(self, h):
        """Piece number of each window hash, -1 if it is none."""
        out = np.full(len(h), -1, np.int64)
        maybe = np.flatnonzero(self.seen[self._low(h)])
        at = np.searchsorted(self.hashes, h[maybe])
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == h[maybe]
        out[maybe[hit]] = self.order[at[hit]]
        return out

    def lattice(self, words: list[str]):
        """(lengths, steps): a step for each position j from 1 lists (l, rows,
        pieces) for the pieces of l code points that end at j in the words
        ``rows``. Steps are made block by block."""
        codes, lengths = _codes(words)
        grid = np.zeros((len(words), int(lengths.max())), np.uint64)
        grid[np.arange(grid.shape[1]) < lengths[:, None]] = codes
        return lengths, self._steps(grid, lengths)

    def _steps(self, grid, lengths):
        n = grid.shape[1]
        for a in range(0, n, _BLOCK):
            b = min(n, a + _BLOCK)
            start = max(0, a - self.longest + 1)
            part = grid[:, start:b]
            steps = [[] for _ in range(b - a)]
            h = part
            for l in range(1, self.longest + 1):
                # h: hashes of the windows of l code points that end at start + l - 1 and later.
                first = max(a, start + l - 1)
                if first >= b:
                    break
                inside = np.arange(first, b)[:, None] < lengths
                ends, rows = np.nonzero(inside)
                found = self.find(h[:, first - (start + l - 1):].T[inside] ^ np.uint64(l))
                if l > 1:
                    hit = found >= 0
                    ends, rows, found = ends[hit], rows[hit], found[hit]
                # A letter that is no piece keeps -1, the last row of a table: unknown.
                cuts = np.searchsorted(ends, np.arange(b - first + 1))
                for i in np.flatnonzero(np.diff(cuts)):
                    steps[first - a + i].append((l, rows[cuts[i]:cuts[i + 1]], found[cuts[i]:cuts[i + 1]]))
                h = h[:, :-1] * _BASE + part[:, l:]
            yield from steps


def _codes(words: list[str]):
    """Code points of all words, flat, and the words' lengths."""
    return (np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64),
            np.fromiter(map(len, words), np.int64, len(words)))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One vocabulary per worker process and file."""
    return Pieces(path)


def forward(lengths, steps, table, longest: int):
    """Log probability of each word in each language, all segmentations
    summed. ``table``: piece probabilities, last row unknown. Only the last
    ``longest`` positions are held, and divided by their largest now and then."""
    width = longest + 1
    alpha = np.zeros((width, len(lengths), table.shape[1]))
    alpha[0] = 1
    scale, out = np.zeros(alpha.shape[1:]), np.zeros(alpha.shape[1:])
    order = np.argsort(lengths, kind="stable")
    cuts = np.searchsorted(lengths[order], np.arange(int(lengths.max()) + 2))
    for j, step in enumerate(steps, 1):
        now = alpha[j % width]
        now[:] = 0
        for l, rows, found in step:
            now[rows] += alpha[(j - l) % width, rows] * table[found]
        done = order[cuts[j]:cuts[j + 1]]
        out[done] = np.log(now[done]) + scale[done]
        if j % _RESCALE == 0:
            most = alpha.max(0)
            most[most == 0] = 1  # words that have ended
            alpha /= most
            scale += np.log(most)
    return out


def expected(lengths, steps, table, language, weight, out):
    """Add the expected counts of the pieces of words, each of one language
    and weight, to ``out`` (flat: language * pieces + piece); in logarithms."""
    n, width, each = int(lengths.max()), len(table), np.arange(len(lengths))
    logs = np.log(table)
    # One column is enough: each word's own language.
    own = [()] + [[(l, rows, found, logs[found, language[rows]]) for l, rows, found in step] for step in steps]
    alpha = np.full((n + 1, len(lengths)), -np.inf)
    alpha[0] = 0
    for j in range(1, n + 1):
        for l, rows, _, p in own[j]:
            alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[j - l, rows] + p)
    beta = np.full((n + 1, len(lengths)), -np.inf)
    beta[lengths, each] = 0
    total = alpha[lengths, each]
    for j in range(n, 0, -1):
        for l, rows, found, p in own[j]:
            flow = p + beta[j, rows]
            beta[j - l, rows] = np.logaddexp(beta[j - l, rows], flow)
            known = found >= 0
            np.add.at(out, language[rows[known]] * width + found[known],
                      (weight[rows] * np.exp(alpha[j - l, rows] + flow - total[rows]))[known])


def _chunks(words: list[str]):
    """Positions of the words by length, so many at a time that they and the
    longest of them make at most ``_CELLS`` (one word at least)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    i = 0
    while i < len(order):
        some = lengths[order[i:i + _CELLS]]
        n = max(1, int(np.searchsorted(some * np.arange(1, len(some) + 1), _CELLS, "right")))
        yield order[i:i + n]
        i += n


def word_scores(words: list[str], vocab: Pieces, table) -> np.ndarray:
    """Log likelihood of each whole word in each language; the empty word scores 0."""
    out = np.zeros((len(words), table.shape[1]))
    full = np.flatnonzero(np.fromiter(map(bool, words), bool, len(words)))
    marked = [START + words[i] for i in full]
    for some in _chunks(marked):
        out[full[some]] = forward(*vocab.lattice([marked[k] for k in some]), table, vocab.longest)
    return out


def _words(texts: pa.Array):
    """Distinct words (lower case, without digits and punctuation around
    them), the word of each piece of the texts, and the texts' offsets."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    cut = pc.utf8_split_whitespace(texts)
    offsets = cut.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    cores = pc.utf8_lower(pc.utf8_trim(coded.dictionary, characters=_EDGE)).dictionary_encode()
    of = cores.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return cores.dictionary.to_pylist(), of[coded.indices.to_numpy(zero_copy_only=False)], offsets - offsets[0]


def fit(df: DataFrame, text_col: str, lang_col: str, vocab_path: str, docs: int = FIT_DOCS):
    """(languages, probability table) from rows of text and language: about
    ``docs`` rows per language, chosen by the hash of their text, without their
    words of over ``FIT_WORD`` code points."""
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    vocab = pieces(vocab_path)
    width = len(vocab.names) + 1
    if not languages:
        return [], np.zeros((width, 0))
    # The share of a language's rows that gives the expected sample size.
    u = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(docs / sizes[name]))])
    sample = rows.where(u < wanted[F.col("lang")])

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words, of, offsets = _words(part.column("text"))
                lang = part.column("lang").dictionary_encode()
                own = np.repeat(lang.indices.to_numpy(zero_copy_only=False), np.diff(offsets)).astype(np.int64)
                key, n = np.unique(own * len(words) + of, return_counts=True)
                yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(key // max(len(words), 1))),
                                                  pa.array(words, pa.string()).take(pa.array(key % max(len(words), 1))),
                                                  pa.array(n, pa.int64())], names=["lang", "word", "n"])

    counts = stored(sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
                    .where(F.col("word") != "").where(F.length("word") <= FIT_WORD).groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    at = {name: i for i, name in enumerate(languages)}
    table = np.full((width, len(languages)), 1.0 / width)
    for _ in range(ROUNDS):
        table[-1] = UNKNOWN

        def expect(batches, table=table):
            vocab = pieces(vocab_path)
            out = np.zeros(width * len(languages))
            for batch in batches:
                lang = np.array([at[x] for x in batch.column("lang").to_pylist()], np.int64)
                weight = batch.column("n").to_numpy(zero_copy_only=False).astype(float)
                words = [START + w for w in batch.column("word").to_pylist()]
                for some in _chunks(words):
                    lengths, steps = vocab.lattice([words[k] for k in some])
                    expected(lengths, steps, table, lang[some], weight[some], out)
            found = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(out[found])], names=["i", "c"])

        sums = counts.mapInArrow(expect, "i long, c double").groupBy("i").agg(F.sum("c").alias("c")).toPandas()
        flat = np.zeros(width * len(languages))
        flat[sums["i"].to_numpy(np.int64)] = sums["c"]
        found = flat.reshape(len(languages), width).T
        # A piece unseen in a language has a little of its share in all of them.
        share = (found.sum(1) + 0.01) / (found.sum() + 0.01 * width)
        table = (found + 10 * share[:, None]) / (found.sum(0) + 10)
    table[-1] = UNKNOWN
    return languages, table


def identify(df: DataFrame, languages: list[str], table, vocab_path: str, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score: the language of the highest likelihood (a
    tie: the first by name) and its posterior under equal priors. A null text,
    one without a letter, or any text if no language was learned: und, score
    0. Null ids stay null, repeated rows are scored each, other columns are
    not read; an empty table gives an empty result."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        vocab = pieces(vocab_path)
        for batch in batches:
            for part in slices(batch, "text"):
                text = part.column("text")
                letter = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                name, score = np.full(len(text), "und", object), np.zeros(len(text))
                if languages:
                    words, of, offsets = _words(text)
                    each = word_scores(words, vocab, table)
                    sums = np.zeros((len(of) + 1, len(languages)))
                    np.cumsum(each[of], axis=0, out=sums[1:])
                    total = sums[offsets[1:]] - sums[offsets[:-1]]
                    best = total.argmax(1)
                    odds = np.exp(total - total.max(1, keepdims=True))
                    name[letter] = np.array(languages, object)[best[letter]]
                    score[letter] = (odds.max(1) / odds.sum(1))[letter]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(name, pa.string()), pa.array(score)],
                                                 names=[id_col, "lang_pred", "score"])

    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double"))


def predict_languages(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """Learn from the rows whose crc32(id as text) mod 3 is not 1 and predict
    all: ``id_col``, held_out (that remainder is 1), lang_pred, score. A row
    with a null id or language is not learned from; a null id is not held out."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    languages, table = fit(df.where(remainder != 1), text_col, lang_col, vocab_path)
    held = F.coalesce(remainder == 1, F.lit(False))
    return (identify(df, languages, table, vocab_path, id_col, text_col)
            .select(id_col, held.alias("held_out"), "lang_pred", "score"))
