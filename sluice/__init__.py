"""sluice: rule-driven data quality on the way from bronze to silver, as Spark jobs.

Subpackages:
  sources    scans, rule catalogues, fixture bronze, generator
  functions  rule normalisation / binding, violation predicates
  operators  split, expectations, dedupe, upsert, change feed, SCD, profiles
  sinks      bucketed keyed tables, quarantine folders, monitor tables
  streaming  foreachBatch bronze -> silver jobs
  plans      per-batch plans, registered queries and their oracle SQL
"""

__version__ = "0.1.0"
