"""lakeloom — governed retail lakehouse operators on Spark DataFrames.

Layers: raw (all-string, ingest-stamped) -> harmonized (typed, quality-gated,
SCD1/SCD2) -> curated (KPI views), plus masking, tagging and layout jobs.
Every operator is a ``DataFrame -> DataFrame`` function; run stamps are
injected so results are reproducible.
"""

__version__ = "0.1.0"
