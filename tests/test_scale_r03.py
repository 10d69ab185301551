"""Steps rewritten to scale: the same values as the plain form, less work a row."""

import glob

from pyspark.sql import functions as F

from conftest import SF0001
from skirmish.functions import rules as R
from skirmish.operators import loaders as L
from skirmish.sources import io as IO
from skirmish.sources.fixtures import Domain

CELLS = ["", " ", "5", "-5", "--5", "- 5", "k-5", "-k5", "007", "+5", "5 %", "1e5", "7.3k", "1,234", "1,234.5", ".5", "5.", " 5 ", "a  b",
         "a\tb", "a b", " a b ", "x", "\x015", "1.2.3", "$12", None]


def _differ(spark, new, old, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return df.select("x", new(F.col("x")).alias("a"), old(F.col("x")).alias("b")).where("NOT (a <=> b)").collect()


def test_rates_round_as_before_without_a_decimal_a_row(spark):
    values = [0.0, -0.0, 0.4375, 1 / 3, 2 / 3, 3 / 128, 5 / 128, -1 / 3, -3 / 128, 0.1234565, 1e-7, 999.9999995, 1e12 / 7, float("nan"), float("inf"), None]
    assert _differ(spark, R.round6, lambda c: F.round(c, 6), values + [n / 10**7 for n in range(0, 3000, 5)], "double") == []


def test_cells_parse_as_before(spark):
    def old_int(c):
        x = R.strip(c)
        digits = F.regexp_extract(x, "[0-9]+", 0).try_cast("bigint")
        return F.when(x.rlike(R.INT_PATTERN), F.when(x.startswith("-"), -digits).otherwise(digits))

    def old_float(c):
        x = R.strip(c)
        return F.when(x.rlike(R.FLOAT_PATTERN), F.regexp_extract(x, R.FLOAT_TOKEN, 0).try_cast("double"))

    assert _differ(spark, R.to_int, old_int, CELLS) == []
    assert _differ(spark, R.to_float, old_float, CELLS) == []
    assert _differ(spark, R.strip_cell, R.strip, CELLS) == []
    assert _differ(spark, R.split_words, lambda c: F.split(c, r"\s+"), CELLS) == []


def test_a_task_takes_few_matches(spark):
    d = Domain(spark, SF0001)
    d.t.put("orders", spark.range(100_001).withColumnRenamed("id", "o_orderkey"))
    assert d.partitions >= 20


def test_sort_moves_maps_and_keeps_the_order(spark):
    d = Domain(spark, SF0001)
    orders = d.t.orders
    few = orders.orderBy("o_orderkey").limit(40)
    twice = few.unionByName(few.limit(7))  # matches that are there twice
    d.t.put("orders", twice.cache())
    got = L.load_rounds(d, sort=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("inline(") < plan.index("rangepartitioning")  # the rows fan out above the sort
    rows, key = [tuple(r) for r in got.collect()], [got.columns.index(c) for c in ("date", "match_id", "map_id", "round_no")]
    keys = [tuple(r[i] for i in key) for r in rows]
    assert keys == sorted(keys, key=lambda k: (-k[0].toordinal(), *k[1:]))
    plain = L.load_rounds(d)
    assert plain.columns == got.columns
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in plain.collect()) and len(rows) > 1000


def test_csv_is_written_compressed_and_read_back(spark, tmp_path):
    df = spark.range(1000).withColumn("t", F.lit("a, \"b\"\nc").substr(1, 4))
    IO.write_csv(df, f"{tmp_path}/out")
    assert glob.glob(f"{tmp_path}/out/*.csv.gz") and not glob.glob(f"{tmp_path}/out/*.csv")
    back = spark.read.schema(df.schema).option("header", True).csv(f"{tmp_path}/out")
    assert back.exceptAll(df).isEmpty() and back.count() == 1000


def test_orphans_are_found_among_numbers_and_texts(spark):
    from skirmish.operators import quality as Q
    rows = [(1, 7, "x"), (1, 8, "y"), (2, None, None), (2, 8, "y"), (None, 9, "z")] * 3
    tables = {"t": spark.createDataFrame(rows, "a long, b int, c string")}
    parents = {"p": spark.range(1, 2), "q": spark.createDataFrame([("y",)], "name string")}
    got = Q.orphans(tables, parents, {"t": {"a": "p", "b": "p", "c": "q"}})
    assert sorted(map(tuple, got.collect())) == [("t.a -> p", "2"), ("t.b -> p", "7"), ("t.b -> p", "8"), ("t.b -> p", "9"),
                                                 ("t.c -> q", "x"), ("t.c -> q", "z")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    keys = [part.split("]")[0] for part in plan.split("Aggregate [")[1:]]  # what is grouped by
    assert keys and not any("check_name" in k for k in keys)  # no text is grouped where a number will do
