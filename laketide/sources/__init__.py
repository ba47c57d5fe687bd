"""Readers: raw CSV files, tables (catalog name or path), run-date slices,
session settings for object stores and table catalogs."""

from laketide.sources.files import read_csv, string_schema  # noqa: F401
from laketide.sources.tables import (  # noqa: F401
    is_path, table_exists, read_table, read_slice, columns_except, schema_from_dict,
    object_store_conf, catalog_conf,
)
