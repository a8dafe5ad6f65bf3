"""Strata: layered warehouses (raw, staging, intermediate, mart) as Spark DataFrame jobs."""

from strata.functions.brazil import parse_date, parse_number
from strata.functions.jsonx import json_array_join, json_field
from strata.functions.names import layer_db, q, resolve_db
from strata.functions.text import strip_enum_prefix, strip_html
from strata.operators.layers import (
    copy_layer,
    create_database,
    list_tables,
    run_log,
    transform_layer,
    write_table,
)
from strata.operators.lineage import layer_inventory, layer_lineage, trace_columns
from strata.operators.merge import merge_pairs
from strata.operators.nullfill import null_fill
from strata.operators.profile import latest_profile, profile_layer, record_profile
from strata.operators.reconcile import differing_rows, reconcile, reconcile_layers
from strata.operators.typed_union import union_typed
from strata.operators.typing_text import LostCells, apply_types, infer_types, type_columns
from strata.operators.union import (
    discover_codes,
    distinct_codes,
    find_relations,
    source_code,
    union_relations,
)
from strata.sources.landing import land
from strata.sources.odata import read_pages
from strata.sources.relational import read_relational, write_relational
from strata.sources.sheets import export_layer, read_sheet, write_sheet

__all__ = [
    "LostCells", "apply_types", "copy_layer", "create_database", "differing_rows", "discover_codes",
    "distinct_codes", "export_layer", "find_relations", "infer_types", "json_array_join", "json_field",
    "land", "latest_profile", "layer_db", "layer_inventory", "layer_lineage", "list_tables",
    "merge_pairs", "null_fill", "parse_date", "parse_number", "profile_layer", "q", "read_pages",
    "read_relational", "read_sheet", "reconcile", "reconcile_layers", "record_profile", "resolve_db",
    "run_log", "source_code", "strip_enum_prefix", "strip_html", "trace_columns", "transform_layer",
    "type_columns", "union_relations", "union_typed", "write_relational", "write_sheet", "write_table",
]
