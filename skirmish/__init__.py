"""skirmish: team-match analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    schemas, fixture domain views, seeds, readers and sinks
functions  scalar rules (Column -> Column), rule registry, HTML cell extraction
operators  loaders, joins, aggregates, windows, set operations, data quality
plans      feature jobs, ingest jobs and the query catalogue
streaming  incremental loading (high-water mark, frontier, TTL, landing stream)
"""

from skirmish.session import get_session, lineage_cut, scratch_dir

__all__ = ["get_session", "lineage_cut", "scratch_dir"]
