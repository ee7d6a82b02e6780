"""Outputs: layer tables, CSV / JSON / Parquet exports."""
