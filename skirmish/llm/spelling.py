"""Spelling variants (operator 13): asymmetric q-chunks.

Of two words that differ by one edit, the shorter (of equal lengths: the lesser)
gives two disjoint chunks that cover it, the other one all positional grams of
the chunks' sizes. One edit spoils at most one chunk, so the other chunk is a
gram of the partner at its own place, or one place later where the partner is
longer by one; grams whose place no chunk can have are not sent. The edit lies
in the first or the second half of what is outside that chunk, so the other half
is equal too: the join is on equality of (length, chunk, place after the shift,
one half), which keeps a frequent chunk such as a common ending from meeting all
its grams. Each pair is verified by its edit distance.

Counting, the join and the roots are DataFrame operations throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.llm.storage import stored

RUNS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = 512  # chunks of one key above which they are dealt to parts


def word_counts(df: DataFrame, id_col: str, text_col: str, spoil: int, shortest: int, least: int) -> DataFrame:
    """word and n (occurrences) over all texts; see ``spelling_variants``."""
    runs = df.select(F.col(id_col).cast("string").alias("id"),
                     F.explode(F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(RUNS), F.lit(0))).alias("run"))
    if spoil:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run").cast("binary"))
        runs = runs.select("run", h.alias("h"))
        at = (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.select(F.when(F.col("h") % spoil == 0, shorter).otherwise(F.col("run")).alias("run"))
    counted = runs.where(F.length("run") >= shortest).groupBy("run").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least).select(F.col("run").alias("word"), "n")


def _head(size: Column) -> Column:
    return F.floor(size / 2).cast("int")


def _keys(word: Column, size: Column, shift: int, less: int) -> list[Column]:
    """Join keys: for both chunks of a word of ``size``, its gram ``shift``
    places later, with either half of what is outside it. ``word`` is longer
    than ``size`` by ``less``."""
    head = _head(size)
    keys = []
    for which, place, width in ((0, F.lit(0), head), (1, head, size - head)):
        gram = F.substring(word, place + shift + 1, width)
        # What is outside: after the first chunk, or before the second; as many letters more as the shift leaves.
        start, rest = (head + shift, size - head) if which == 0 else (F.lit(0), head)
        more = less - shift if which == 0 else shift
        half = _head(rest)
        for part, at, n in ((0, start, half), (1, start + half + more, rest - half)):
            keys.append(F.xxhash64(F.lit(2 * which + part), size, gram, F.substring(word, at + 1, n)))
    return keys


def _chunks(words: DataFrame) -> DataFrame:
    """The keys of each word's own two chunks."""
    keys = _keys(F.col("word"), F.col("size"), 0, 0)
    return words.select("word", F.explode(F.array(*keys)).alias("key"))


def _grams(words: DataFrame) -> DataFrame:
    """The keys of each word's positional grams that can equal a chunk of a
    word of its own size (same place) or of one letter less (same place, or one
    later)."""
    word, size = F.col("word"), F.col("size")
    keys = _keys(word, size, 0, 0) + _keys(word, size - 1, 0, 1) + _keys(word, size - 1, 1, 1)
    return words.select(word.alias("other"), F.explode(F.array_distinct(F.array(*keys))).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair of words one edit apart, once: word (the shorter or lesser) and other.
    ``words``: distinct words, as column word."""
    sized = words.select("word", F.length("word").alias("size"))
    chunks, grams = _chunks(sized), _grams(sized)
    # A key with many chunks is dealt to parts; its grams meet each part.
    large = stored(chunks.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > SPLIT), "large-keys")
    parts = F.ceil(F.col("k") / F.lit(SPLIT)).cast("int")
    few = (chunks.join(large, "key", "left_anti").withColumn("part", F.lit(0)),
           grams.join(large, "key", "left_anti").withColumn("part", F.lit(0)))
    many = (chunks.join(large, "key").withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int")).drop("k"),
            grams.join(large, "key").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("k"))
    out = None
    for x, y in (few, many):
        met = x.join(y, ["key", "part"])
        met = met.where((F.length("other") > F.length("word")) | (F.col("other") > F.col("word")))
        found = met.where(F.levenshtein("word", "other", 1) == 1).select("word", "other")
        out = found if out is None else out.union(found)
    return out.distinct()


def _rooted(forms: DataFrame) -> DataFrame:
    """word and root of every word with a form, by pointer jumping. A form has
    at least twice its word's count, so rounds grow with the logarithm of the
    logarithm of the largest count; one row count a round comes to the driver."""
    state = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(state.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "roots")
        state = step.select("word", "root")
        if step.where("moved").isEmpty():
            return state


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", spoil: int = 97,
                      shortest: int = 5, least: int = 3, factor: int = 2) -> DataFrame:
    """Groups the words of all texts by spelling.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of the whole text,
    lower-cased in A-Z only. With ``spoil``, a run whose crc32 of
    ``<id>:<run>`` (a null id is written as nothing) is divisible by it loses
    the code point at that value modulo its length (0: none is spoilt). Kept are
    words of at least ``shortest`` (5 or more) code points and ``least``
    occurrences.

    Returns word, n, n_near (words one inserted, deleted or replaced code point
    away), form (its near word of largest n, ties: the smallest in code-point
    order, if that n is at least ``factor`` (2 or more) times its own, else
    null), form_n and root (the end of its forms; the word itself without one).
    Null and empty texts have no words; repeated rows count each; other columns
    are not read; an empty table gives an empty result.
    """
    words = stored(word_counts(df, id_col, text_col, spoil, shortest, least), "words")
    pairs = near_pairs(words.select("word"))
    both = pairs.union(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    counted = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form")))
    near = both.join(counted, "other").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    strong: Column = -F.col("best.rank") >= F.lit(factor) * F.col("n")
    formed = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                  F.when(strong, F.col("best.form")).alias("form"),
                                  F.when(strong, -F.col("best.rank")).alias("form_n")), "forms")
    root = _rooted(formed.where("form is not null"))
    return formed.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
