"""Quality classifier (operator 8): hierarchical empirical Bayes.

A logistic classifier on style numbers gives each document's evidence. Sites
(host, and path below it) have a posterior share of good documents: grouped
sums of the classifier's probabilities, shrunk towards the level above with a
strength estimated from the spread between sites (a sparse site stays near its
host, a sparse host near all). A document's verdict is its evidence on top of
its site's posterior odds, the document itself left out of its site.
Only per-site sums are shuffled, combined before the shuffle, so a hot site
costs no more than others; the classifier is fitted on a bounded sample of
labelled rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.llm.storage import stored

FIT_ROWS = 20_000  # labelled documents that the classifier is fitted on at most
RIDGE = 1.0
THRESHOLD = 0.5
MAX_STRENGTH = 1e6  # documents that a prior counts for at most

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\"
NAMES = ["lower", "upper", "digit", "high", "blank", "control", *[f"mark{b}" for b in _MARKS],
         "distinct_words", "distinct_lines", "word_length", "long_words", "short"]


def style(text: bytes) -> np.ndarray:
    """Style numbers of a text: roots of the shares of character classes, and
    of repetition and word length. All zero but ``short`` for an empty text."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total = max(1, len(text))
    blank = n[9:14].sum() + n[32]
    words = text.split()
    lines = text.split(b"\n")
    classes = [n[97:123].sum(), n[65:91].sum(), n[48:58].sum(), n[128:].sum(), blank, n[:9].sum() + n[14:32].sum(),
               *n[list(_MARKS)]]
    m = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.r_[np.sqrt(np.array(classes) / total),
                 # The share of distinct words falls with length: compared with its square root.
                 math.log1p(len(set(words)) / math.sqrt(m)), math.sqrt(len(set(lines)) / max(1, len(lines))),
                 math.log1p((total - blank) / m), math.sqrt((sizes > 25).sum() / m), 1 / math.sqrt(m)]


def style_table(df: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` (aliased k0, k1, ...) and the style numbers x0, x1, ... of every row."""
    kept = df.select(*[c.alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    names = [f"x{i}" for i in range(len(NAMES))]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [f"{x} float" for x in names])

    def run(batches):
        for batch in batches:
            x = np.array([style(t.as_buffer().to_pybytes()) for t in batch.column("text")], np.float32).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(c) for c in np.ascontiguousarray(x.T)],
                                             names=batch.schema.names[:-1] + names)

    return kept.mapInArrow(run, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights and bias for raw numbers, by Newton steps on standardised ones.
    One class alone (or no row) gives zero weights and a smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1]), math.log(share / (1 - share))
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def strength(sites: DataFrame, key: list[str]) -> tuple[float, float]:
    """Mean share and prior strength (in documents) for the spread of the
    shares between sites, from sums per site (n, s, q): analysis of variance."""
    by = sites.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])
    r = by.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
               F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between")).first()
    if not r["n"]:
        return 0.5, 1.0
    mean = (r["s"] + 0.5) / (r["n"] + 1)
    if r["k"] < 2 or r["n"] <= r["k"]:
        return mean, MAX_STRENGTH
    within = max((r["q"] - r["between"]) / (r["n"] - r["k"]), 1e-9)
    size = max((r["n"] - r["nn"] / r["n"]) / (r["k"] - 1), 1e-9)
    spread = ((r["between"] - r["s"] ** 2 / r["n"]) / (r["k"] - 1) - within) / size
    return mean, min(MAX_STRENGTH, within / spread) if spread > 0 else MAX_STRENGTH


def quality_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   host_col: str = "source", path_col: str = "lang", label_col: str = "quality",
                   key_col: str | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Quality of every document: ``id_col``, evidence (the classifier's log
    odds against those of its sample), site_share (posterior share of good
    documents at its site without it), p_quality, kept (p_quality >= 0.5).

    ``labels``: ``key_col`` (default ``id_col``; also a column of ``df``) and
    ``label_col``, 1 good and 0 bad; repeated keys count by their mean, other
    values are ignored. ``fit_rows``
    bounds the sample, those with the least hash of their id. A null text is an
    empty one; a null host or path is a site of its own; null ids have no label
    and stay null; repeated rows are scored each; other columns are not read.
    Without labels every document is kept at p_quality 0.5; an empty table gives
    an empty result.
    """
    key_col = key_col or id_col
    names = [f"x{i}" for i in range(len(NAMES))]
    table = stored(style_table(df, text_col, [F.col(key_col), F.col(id_col),
                                              F.coalesce(F.col(host_col).cast("string"), F.lit("")),
                                              F.coalesce(F.col(path_col).cast("string"), F.lit(""))]), "style")
    given = (labels.select(F.col(key_col).alias("k0"), F.col(label_col).cast("double").alias("y"))
             .where("k0 is not null and y in (0, 1)").groupBy("k0").agg(F.round(F.avg("y")).alias("y")))
    sample = (table.join(given, "k0").select(F.xxhash64("k0").alias("h"), "k0", "y", F.array(*names).alias("x"))
              .orderBy("h", "k0", "x").limit(fit_rows).toPandas())
    x = np.array(sample["x"].tolist(), float).reshape(-1, len(names))
    weights, bias = fit_logistic(x, sample["y"].to_numpy(float))
    share = (sample["y"].sum() + 1) / (len(sample) + 2)
    prior = math.log(share / (1 - share))

    odds = F.lit(bias)
    for w, name in zip(weights.tolist(), names):
        odds = odds + F.lit(w) * F.col(name)
    odds = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds))
    scored = table.select("k1", F.col("k2").alias("host"), F.col("k3").alias("path"), odds.alias("odds"),
                          (1 / (1 + F.exp(-odds))).alias("p"))
    sites = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"),
                                                      F.sum(F.col("p") * F.col("p")).alias("q")), "sites")
    mean, host_strength = strength(sites, ["host"])
    _, path_strength = strength(sites, ["host", "path"])
    hosts = sites.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    site = stored(sites.join(hosts, "host"), "site-posteriors")
    host_share = (F.col("hs") - F.col("p") + mean * host_strength) / (F.col("hn") - 1 + host_strength)
    site_share = (F.col("s") - F.col("p") + host_share * path_strength) / (F.col("n") - 1 + path_strength)
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), site_share))
    evidence = F.col("odds") - prior
    return (scored.join(site, ["host", "path"])
            .select(F.col("k1").alias(id_col), evidence.alias("evidence"), bounded.alias("site_share"))
            .withColumn("p_quality", 1 / (1 + F.exp(-(F.col("evidence") + F.log(F.col("site_share") / (1 - F.col("site_share")))))))
            .withColumn("kept", F.col("p_quality") >= THRESHOLD))
