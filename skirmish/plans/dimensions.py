"""Surrogate keys over two levels: regions first, then the countries that refer
to them, then teams and players that hold both as ids.

A stored row keeps its id; a name that geography resolves and the table lacks
gets an id after the stored maximum, in name order, so a run repeated on the
same input gives the same ids and one on its own result adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.plans import ingest as I
from skirmish.sources import raw_views as RV
from skirmish.sources.fixtures import Domain


def get_or_create(existing: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name): ``existing`` and the names it lacks; null names add nothing."""
    known = existing.select("id", "name")
    new = names.select("name").where(F.col("name").isNotNull()).distinct().join(known.select("name"), "name", "left_anti")
    start = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("start"))
    numbered = I.dense_ids(new, "name", 0).crossJoin(F.broadcast(start))  # one row
    return known.unionByName(numbered.select((F.col("start") + F.col("id")).cast("bigint").alias("id"), "name"))


def stored_regions(d: Domain) -> DataFrame:
    """Region dimension as stored before the run: all but the last one."""
    last = d.t.region.agg(F.max("r_regionkey").alias("last"))
    return d.t.region.crossJoin(F.broadcast(last)).where("r_regionkey < last").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"), F.col("r_name").alias("name"))


def countries_named(d: Domain) -> DataFrame:
    """Names of the countries stored or held by a team or a player."""
    return (I.stored_countries(d).select("name")
            .unionByName(I.job_teams(d).select(F.col("country").alias("name")))
            .unionByName(I.job_players(d).select(F.col("country").alias("name"))).where("name is not null").distinct())


def regions(d: Domain) -> DataFrame:
    """Regions, those created for a team or for a country of ``countries`` included."""
    of_countries = countries_named(d).join(RV.geography(d), F.col("name") == F.col("country")).select(F.col("continent").alias("name"))
    return get_or_create(stored_regions(d), I.job_teams(d).select(F.col("region").alias("name")).unionByName(of_countries))


def countries(d: Domain) -> DataFrame:
    """(id, name, region_id): countries with the id of their region."""
    place = RV.geography(d).select(F.col("country").alias("name"), F.col("continent"))
    region = regions(d).select(F.col("id").alias("region_id"), F.col("name").alias("continent"))
    return (get_or_create(I.stored_countries(d), countries_named(d)).join(place, "name", "left")
            .join(region, "continent", "left").select("id", "name", "region_id"))


def _with_id(facts: DataFrame, dim: DataFrame, column: str) -> DataFrame:
    """The name in ``column`` becomes the id in ``column``_id."""
    ids = dim.select(F.col("id").alias(f"{column}_id"), F.col("name").alias(column))
    return facts.join(ids, column, "left").drop(column)


def teams_with_ids(d: Domain) -> DataFrame:
    """Teams holding country and region ids (null where none was resolved)."""
    return _with_id(_with_id(I.job_teams(d), countries(d), "country"), regions(d), "region")


def players_with_ids(d: Domain) -> DataFrame:
    """Players holding country ids."""
    return _with_id(I.job_players(d), countries(d), "country")
