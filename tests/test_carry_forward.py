"""The segmented scan against a plain loop."""

import random

from pyspark.sql import functions as F

from skirmish.operators.windows import carry_forward


def test_last_value_is_carried_over_blocks(spark):
    rng = random.Random(9)
    rows = []
    for key, n, share in (("long", 900, 0.01), ("dense", 120, 0.5), ("none", 40, 0.0), ("one", 1, 1.0)):
        for pos in sorted(rng.sample(range(5000), n)):
            rows.append((key, pos, f"h{pos}" if rng.random() < share else None))
    rows.append((None, 3, "x"))
    df = spark.createDataFrame(rows, "k string, pos long, header string").where("k is not null")
    want, last = {}, {}
    for k, pos, header in rows:
        last[k] = header or last.get(k)
        want[k, pos] = last[k]
    for width, levels in ((3, 1), (3, 4), (50, 2), (1000, 3)):
        got = {(r["k"], r["pos"]): r["carried"] for r in carry_forward(df, ["k"], "pos", F.col("header"), "carried", width, levels).collect()}
        assert got == {x: v for x, v in want.items() if x[0] is not None}
    assert carry_forward(df.limit(0), ["k"], "pos", F.col("header"), "carried").count() == 0
