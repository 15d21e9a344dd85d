"""duoweave: bilingual page-corpus engine on Spark DataFrames.

Stages (all lazy DataFrame -> DataFrame functions):
links and listings -> fetched pages -> layout extraction -> cleaning and
script labels -> per-page routing -> sentence alignment -> numbered pairs
-> CSV / Parquet sinks.  See README.md for the map of modules.
"""

__all__ = ["session"]
