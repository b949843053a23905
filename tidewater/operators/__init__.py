"""Row-level operators: lookups, projections, documents, positions, dedup."""

from tidewater.operators.counters import count_as, step_counters
from tidewater.operators.dedup import distinct_keys, last_by_key
from tidewater.operators.documents import build_documents, explode_documents, merge_refunds, nest_items
from tidewater.operators.merge import (exists_split, flatten_json, flatten_struct, lookup_chain, lookup_join,
                                       matched_keys, not_blank, overlay_non_null, strict_lookup)
from tidewater.operators.orders import (attach_items, build_order_documents, enrich_address, enrich_refund,
                                        nest_orders, order_rows, refund_duplicates, resolve_gorders)
from tidewater.operators.projection import (non_empty_groups, project_columns, project_defaults, require_key,
                                            split_rows)
from tidewater.operators.ranking import nest_children, position_in_group
from tidewater.operators.steps import flatten_any, service_step, spread_pairs

__all__ = [n for n in dir() if not n.startswith("_")]
