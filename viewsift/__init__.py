"""viewsift: pageview ingest, rule filtering, batch scoring and analytics as Spark jobs.

Sub-packages: ``sources`` (dumps, files, pages, warehouse tables, testbed),
``functions`` (rule expressions, exact rounding), ``operators`` (prefilter,
scoring, loads, checks, ranking, fuzzy search), ``plans`` (analytics queries,
registered jobs, SQL oracles) and ``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
