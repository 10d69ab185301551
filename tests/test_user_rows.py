"""User row logic gets whole groups, many a call; matches are dealt to enough partitions."""

import random

from skirmish.functions.registry import apply_user_rows
from skirmish.plans.q_sources import _longest_streak

SCHEMA = "match_id long, map_id long, team_id long, longest_streak long"


def test_streaks_of_many_maps_in_few_calls(spark):
    rng = random.Random(3)
    rows = [(m, k, n, rng.choice([m % 7 + 1, 9])) for m in range(150) for k in (1, 2) for n in range(1, rng.randrange(3, 25))]
    rows += [(900, 1, 1, None), (900, 1, 2, None), (900, 1, 3, 5)]
    rng.shuffle(rows)
    want = {}
    for m, k in {r[:2] for r in rows}:
        best, run, last = {}, 0, None
        for _, t in sorted((n, t) for mm, kk, n, t in rows if (mm, kk) == (m, k) and t is not None):
            run = run + 1 if t == last else 1
            last = t
            best[t] = max(best.get(t, 0), run)
        want |= {(m, k, t): n for t, n in best.items()}
    df = spark.createDataFrame(rows, "match_id long, map_id long, round_no int, team_won long")
    calls = spark.sparkContext.accumulator(0)

    def counted(pdf):
        calls.add(1)
        return _longest_streak(pdf)

    got = apply_user_rows(df, ["match_id", "map_id"], counted, SCHEMA).collect()
    assert {tuple(r)[:3]: r["longest_streak"] for r in got if r["team_id"] is not None} == want
    assert [tuple(r) for r in got if r["team_id"] is None] == [(900, 1, None, 1)] * 2
    assert 0 < calls.value <= 16  # not one a map (301)
    assert apply_user_rows(df.limit(0), ["match_id", "map_id"], _longest_streak, SCHEMA).count() == 0


def test_partitions_grow_with_the_matches(spark, monkeypatch):
    from skirmish.sources import fixtures
    path = "/root/testdata/sf0.001"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fixtures.Domain(spark, path).partitions == least
    monkeypatch.setattr(fixtures, "PART_MATCHES", 70)
    d = fixtures.Domain(spark, path)
    assert d.matches.rdd.getNumPartitions() == -(-d.t.orders.count() // 70) > least
    assert fixtures.Domain(spark, path, 3).partitions == 3
