"""Sources: the queue, table lookups, document and wide-column reads."""

from tidewater.sources.colocated import store_bucketed
from tidewater.sources.queue import claim, poll, requeue
from tidewater.sources.search import get_document, get_documents, page_end, search_after, search_page
from tidewater.sources.tables import jdbc_table, table
from tidewater.sources.widecolumn import (cells_from_rows, get_row, get_rows, keep_cells, pivot_rows,
                                          scan_range, scan_time_range)

__all__ = [n for n in dir() if not n.startswith("_")]
