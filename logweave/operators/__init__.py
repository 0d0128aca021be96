from .layout import (assign_key, assign_offset, assign_partition,
                     format_sink_record)
from .progress import catch_up, committed_offsets, consumer_lag
from .spans import SpanPlan, plan_spans
from .stateless import (filter_odd_hash, filter_records, flatmap_chars,
                        flatmap_entries, flatmap_records, flatmap_table,
                        map_entries,
                        map_records, map_upper, rekey)
from .window import (check_window, count_window, evicted_values, prior_window,
                     window_aggregate, window_snapshot)

__all__ = [
    "SpanPlan", "assign_key", "assign_offset", "assign_partition", "catch_up",
    "check_window", "committed_offsets", "consumer_lag", "count_window",
    "evicted_values", "filter_odd_hash", "filter_records", "flatmap_chars",
    "flatmap_entries", "flatmap_records", "flatmap_table", "format_sink_record", "map_entries",
    "map_records", "map_upper", "plan_spans", "prior_window", "rekey",
    "window_aggregate", "window_snapshot",
]
