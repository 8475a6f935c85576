"""Operators of a training-data pipeline.  Nothing outside this folder imports them but the entry module, which can do without."""
