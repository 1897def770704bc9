"""Sources and sinks: raw CSV, Parquet fact/summary tables, SQL views, and
the raw-sales view over the star-schema test tables."""
