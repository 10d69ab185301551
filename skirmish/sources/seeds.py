"""Seed dimensions: maps, agents and the dated map pool.

Ids follow insert order, as in the reference's seed script.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's seed rows.
# Maps (name, release date), in insert order (id = position + 1):
MAPS = [
    ("Ascent", "2020-06-02"), ("Bind", "2020-04-07"), ("Breeze", "2021-04-27"), ("Corrode", "2025-06-24"),
    ("Haven", "2020-04-07"), ("Icebox", "2020-10-13"), ("Lotus", "2023-01-10"), ("Pearl", "2022-06-22"),
    ("Split", "2020-04-07"), ("Sunset", "2023-08-29"), ("Abyss", "2024-06-11"), ("Fracture", "2021-09-08"),
]
# Agents (name, role, release date), in insert order (id = position + 1):
AGENTS = [
    ("Astra", "controller", "2021-03-02"), ("Breach", "initiator", "2020-04-07"),
    ("Brimstone", "controller", "2020-04-07"), ("Chamber", "sentinel", "2021-11-16"),
    ("Clove", "controller", "2024-03-26"), ("Cypher", "sentinel", "2020-04-07"),
    ("Deadlock", "sentinel", "2023-08-29"), ("Fade", "initiator", "2022-04-27"),
    ("Gekko", "initiator", "2023-03-07"), ("Harbor", "controller", "2022-10-18"),
    ("Iso", "duelist", "2023-10-31"), ("Jett", "duelist", "2020-04-07"),
    ("Kayo", "initiator", "2021-06-22"), ("Killjoy", "sentinel", "2020-08-04"),
    ("Neon", "duelist", "2022-01-11"), ("Omen", "controller", "2020-04-07"),
    ("Phoenix", "duelist", "2020-04-07"), ("Raze", "duelist", "2020-04-07"),
    ("Reyna", "duelist", "2020-06-02"), ("Sage", "sentinel", "2020-04-07"),
    ("Skye", "initiator", "2020-10-27"), ("Sova", "initiator", "2020-04-07"),
    ("Viper", "controller", "2020-04-07"), ("Vyse", "sentinel", "2024-08-28"),
    ("Yoru", "duelist", "2021-01-12"), ("Tejo", "initiator", "2025-01-08"),
    ("Waylay", "duelist", "2025-03-04"),
]
# Map pool snapshots: (date, patch, map names in the pool), in date order.
MAP_POOL = [
    ("2020-06-02", "1.0", ["Ascent", "Bind", "Haven", "Split"]),
    ("2020-10-13", "1.08", ["Ascent", "Bind", "Haven", "Split", "Icebox"]),
    ("2021-04-27", "2.08", ["Ascent", "Bind", "Haven", "Split", "Icebox", "Breeze"]),
    ("2021-09-08", "3.05", ["Ascent", "Bind", "Haven", "Split", "Icebox", "Breeze", "Fracture"]),
    ("2022-06-22", "5.0", ["Ascent", "Bind", "Haven", "Icebox", "Breeze", "Fracture", "Pearl"]),
    ("2023-01-10", "6.0", ["Ascent", "Haven", "Icebox", "Breeze", "Fracture", "Pearl", "Lotus"]),
    ("2023-04-25", "6.08", ["Ascent", "Haven", "Breeze", "Pearl", "Lotus", "Split", "Bind"]),
    ("2023-08-29", "7.04", ["Ascent", "Haven", "Bind", "Split", "Lotus", "Sunset", "Breeze"]),
    ("2024-01-09", "8.0", ["Ascent", "Bind", "Split", "Lotus", "Sunset", "Breeze", "Icebox"]),
    ("2024-06-11", "8.11", ["Ascent", "Bind", "Split", "Sunset", "Breeze", "Abyss", "Haven"]),
    ("2024-10-22", "9.08", ["Ascent", "Bind", "Haven", "Sunset", "Abyss", "Pearl", "Split"]),
    ("2025-01-08", "10.00", ["Abyss", "Bind", "Haven", "Fracture", "Lotus", "Pearl", "Split"]),
    ("2025-03-04", "10.04", ["Haven", "Fracture", "Lotus", "Pearl", "Split", "Icebox", "Ascent"]),
    ("2025-04-29", "10.08", ["Ascent", "Haven", "Icebox", "Lotus", "Pearl", "Split", "Sunset"]),
    ("2025-06-10", "10.10", ["Ascent", "Haven", "Icebox", "Lotus", "Pearl", "Split", "Sunset"]),
    ("2025-06-24", "11.00", ["Ascent", "Haven", "Icebox", "Lotus", "Sunset", "Bind", "Corrode"]),
]
# ---------------------------------------------------------------------------


def seed_maps(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, n, d) for i, (n, d) in enumerate(MAPS)]
    return spark.createDataFrame(rows, "id bigint, name string, release_date string")


def seed_agents(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, n, r, d) for i, (n, r, d) in enumerate(AGENTS)]
    return spark.createDataFrame(rows, "id int, name string, agent_type string, release_date string")


def seed_map_pool(spark: SparkSession) -> DataFrame:
    """Pool rows with the map name resolved to its id (first id by name)."""
    rows = [(d, p, name) for d, p, names in MAP_POOL for name in names]
    pool = spark.createDataFrame(rows, "date string, patch_no string, name string")
    maps = F.broadcast(seed_maps(spark).select("name", F.col("id").alias("map_id")))
    return pool.join(maps, "name", "left").select("date", "patch_no", "map_id")
