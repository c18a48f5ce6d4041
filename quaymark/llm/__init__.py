"""Training-data operators: tokens, media, language, HTML, PII, joins, packing and quality.

Nothing else in the library imports this subpackage.  Every operator takes and returns
DataFrames; what executors must share is staged as Parquet below ``spark.checkpoint.dir``.
"""
