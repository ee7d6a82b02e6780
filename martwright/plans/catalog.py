"""Catalogue of registered queries (one per operator of the survey inventory).

Each query runs over the whole driver tables through the adapter; the SQL
string next to it is the DuckDB oracle over the same tables.
"""

from __future__ import annotations

from martwright.plans import (  # noqa: F401
    catalog_io, catalog_models, catalog_serving, catalog_warehouse,
)
