"""Range-coded windows and the training document against plain Python."""

import collections
import datetime as dt
import json
import random

from pyspark.sql import functions as F

SF0001 = "/root/testdata/sf0.001"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_ranges_expand_to_their_windows(spark):
    from skirmish.operators.ranges import expanded, numbered, ranges
    rng = random.Random(4)
    events = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(6)}", day(rng.randrange(300)), i) for i in range(800)]
    points = [(k, day(n)) for k in ["hot", "k0", "k3", "nobody"] for n in (0, 1, 30, 31, 150, 299, 300, 900)] + [("hot", day(30))]
    ev = spark.createDataFrame(events, "k string, d date, id int")
    pt = spark.createDataFrame(points, "k string, d date")
    num = numbered(ev, ["k"], "d", ["id"])
    got = collections.defaultdict(list)
    for r in num.collect():
        got[r["k"]].append((r["seq"], r["d"], r["id"]))
    for k, xs in got.items():
        assert [(d, i) for _, d, i in sorted(xs)] == sorted((d, i) for kk, d, i in events if kk == k)
        assert sorted(s for s, _, _ in xs) == list(range(1, len(xs) + 1))
    coded = ranges(ev, pt, ["k"], "d", 30)
    assert coded.count() == len(set(points))
    rows = {(r["k"], r["d"]): (r["lo"], r["hi"]) for r in coded.collect()}
    assert all(rows[k, d] == (sum(kk == k and x < d - dt.timedelta(days=30) for kk, x, _ in events),
                              sum(kk == k and x < d for kk, x, _ in events)) for k, d in set(points))
    want = {(k, d, i) for k, d in set(points) for kk, x, i in events if kk == k and d - dt.timedelta(days=30) <= x < d}
    named = coded.withColumnRenamed("d", "at")
    found = [(r["k"], r["at"], r["id"]) for r in expanded(named, num, ["k"]).collect()]
    assert len(found) == len(want) and set(found) == want
    assert ranges(ev.limit(0), pt, ["k"], "d", 30).where("hi > 0").count() == 0
    assert ranges(ev, pt.limit(0), ["k"], "d", 30).count() == 0


def test_training_document_of_named_targets(spark, tmp_path):
    """A target that was never played, and one on a day without matches before it."""
    from skirmish.plans import features as FT
    from skirmish.sources import io as IO
    from skirmish.sources.fixtures import Domain
    d = Domain(spark, SF0001)
    last = d.matches.agg(F.max("date")).first()[0]
    first = d.matches.agg(F.min("date")).first()[0]
    named = spark.createDataFrame([(-1, last + dt.timedelta(days=3), "playoff", 1, 4, 9), (-2, first, "group_stage", 2, 4, 9)],
                                  "target_id long, target_date date, stage string, tier int, team_1_id long, team_2_id long")
    doc = FT.training_document(d, named)
    FT.FORM_PART = 3  # forms in many parts
    whole = FT.with_forms(doc, FT.training_forms(d, doc))
    FT.FORM_PART = 1000
    IO.write_json(whole, f"{tmp_path}/doc")
    text = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/doc").collect()]
    matches = d.matches.collect()
    maps = {(r["match_id"], r["team_id"], r["map_id"]): r for r in FT.feat_match_maps(d).collect()}
    league = {(r["match_id"], r["map_id"]): r for r in FT.feat_maps(d).collect()}
    date_of = {m["id"]: m["date"] for m in matches}
    at = last + dt.timedelta(days=3)
    lo = at - dt.timedelta(days=180)

    def record(row, fields):  # JSON leaves nulls out
        return {f: row[f] for f in fields if row[f] is not None}

    want = []
    for side, team in ((1, 4), (2, 9)):
        for m in matches:
            if team in (m["team_1_id"], m["team_2_id"]) and lo <= m["date"] < at:
                own, other = ("team_1", "team_2") if m["team_1_id"] == team else ("team_2", "team_1")
                one = {"target_id": -1, "side": side, "target_stage": "playoff", "target_tier": 1, "history_id": m["id"],
                       "form_date": str(at), "maps": []}
                one |= record({"stage": m["stage"], "team_score": m[f"{own}_score"], "team_against_score": m[f"{other}_score"],
                               "team_rating": m[f"{own}_rating"], "team_against_rating": m[f"{other}_rating"]},
                              ["stage", "team_score", "team_against_score", "team_rating", "team_against_rating"])
                for (match, t, map_id), row in sorted(maps.items()):
                    if match == m["id"] and t == team:
                        numbers = {i: n for n, (_, i) in enumerate(sorted((date_of[i], i) for i, k in league if k == map_id), 1)}
                        form = [{"seq": numbers[i], "match_id": i} | record(league[i, map_id], FT.FORM_FEATURES)
                                for i in sorted(numbers, key=numbers.get) if lo <= date_of[i] < at]
                        one["maps"].append({"map_id": map_id} | record(row, FT.MAP_FEATURES) | {"map_form": form})
                want.append(one)

    def order(x):
        return sorted(x, key=lambda r: (r["side"], r["history_id"]))

    assert len(FT.MAP_FEATURES) == 17
    assert len(want) > 5 and order(text) == order(want)


def test_ranges_do_not_grow_with_the_window(spark):
    """One row per target side, whatever the window holds."""
    from skirmish.plans import features as FT
    from skirmish.sources.fixtures import Domain
    d = Domain(spark, SF0001)
    assert FT.history_ranges(d, days=10).count() == FT.history_ranges(d, days=2000).count() == 2 * d.matches.count()
