"""Inputs: the driver-table adapter and the raw CSV reader (manifest check, header scan)."""
