"""Get-or-create of a dimension: stored ids stay, a repeated run adds nothing."""

from skirmish.plans.dimensions import get_or_create


def test_ids_are_stable_under_retries(spark):
    stored = spark.createDataFrame([(1, "Asia"), (7, "Europe")], "id long, name string")
    names = spark.createDataFrame([("Oceania",), ("Africa",), ("Asia",), (None,), ("Africa",)], "name string")
    once = get_or_create(stored, names)
    want = [(1, "Asia"), (7, "Europe"), (8, "Africa"), (9, "Oceania")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, get_or_create(once, names).collect())) == want
    assert sorted(map(tuple, get_or_create(stored.limit(0), names).collect())) == [(1, "Africa"), (2, "Asia"), (3, "Oceania")]
