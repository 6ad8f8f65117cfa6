"""landfall: a Spark-native batch engine that turns raw travel-admission
records and their companion reference data into an analysis-ready star of
partitioned Parquet tables.

Layout
------
``sources``    readers: delimited files, ``key = 'label'`` code lists, raw admissions
``functions``  column expressions (date repair, placeholder and white-space clean-up)
``operators``  DataFrame -> DataFrame building blocks (keep-first de-duplication,
               code unions, checked broadcast lookups, quality reports)
``plans``      the dimension and fact jobs, mart writer/reader, the full star build

Everything is expressed with built-in Spark expressions, so Catalyst keeps
filters and projections at the scan and whole-stage codegen stays intact.
"""

__version__ = "0.1.0"
