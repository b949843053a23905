"""Sinks: pure ``(target, batch) -> target`` functions and the appended target
of streams."""

from tidewater.sinks.appended import AppendedTable
from tidewater.sinks.layout import read_routed, routing_bucket, write_routed
from tidewater.sinks.search import (delete_by_query, delete_documents, index_documents, index_with_parent,
                                    replace_groups, update_documents)
from tidewater.sinks.table import bind_positional, insert_rows, upsert, upsert_actions, upsert_commission
from tidewater.sinks.widecolumn import delete_rows, put_cells

__all__ = [n for n in dir() if not n.startswith("_")]
