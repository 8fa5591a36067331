"""tablesmith: table sync and table operations as Spark DataFrame plans.

Every operator takes a DataFrame (plus parameters) and returns a DataFrame;
only the sinks and the job plans run actions.
"""

from tablesmith.functions import expressions as fx
from tablesmith.operators.clean import clean_number, clean_numbers, normalise_boolean, null_normalise, null_tokens
from tablesmith.operators.columns import (TableView, add_column, apply_formulas, delete_column, hide_columns,
                                          rename_column, show_columns)
from tablesmith.operators.lookup import lookup, remove_lookup
from tablesmith.operators.mapping import (ColumnMap, MappingError, map_columns, mapping_collect, mapping_document,
                                          parse_mapping, type_map, typed_column, validate_mapping)
from tablesmith.operators.merge import append, conform, insert_ignore, truncate_add, upsert
from tablesmith.operators.profile import ReportSpec, load_audit, profile_column, profile_table, similar_report
from tablesmith.operators.rowid import dedup, first_wins, row_id
from tablesmith.operators.rows import add_rows, delete_where, update_where
from tablesmith.operators.sketches import merge_sketches, sketch_report, table_sketches

__all__ = [
    "fx", "clean_number", "clean_numbers", "normalise_boolean", "null_normalise", "null_tokens",
    "TableView", "add_column", "apply_formulas", "delete_column", "hide_columns", "rename_column", "show_columns",
    "lookup", "remove_lookup",
    "ColumnMap", "MappingError", "map_columns", "mapping_collect", "mapping_document", "parse_mapping", "type_map",
    "typed_column", "validate_mapping",
    "append", "conform", "insert_ignore", "truncate_add", "upsert",
    "ReportSpec", "load_audit", "profile_column", "profile_table", "similar_report",
    "dedup", "first_wins", "row_id",
    "add_rows", "delete_where", "update_where",
    "merge_sketches", "sketch_report", "table_sketches",
]
