"""Sources and sinks: page tables, listing responses, CSV / Parquet / text outputs."""
