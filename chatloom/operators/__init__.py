from .censoring import censor_messages, drop_profane_messages
from .formatting import format_messages, parse_messages, quarantine_messages
from .ranking import count_messages, top_channels, top_counted, top_keys, top_users
from .steps import load_steps, with_steps
from .timing import compare_groups, compare_runs, latency_summary, load_rate, stamp_latency

__all__ = [
    "censor_messages",
    "compare_groups",
    "compare_runs",
    "count_messages",
    "drop_profane_messages",
    "format_messages",
    "latency_summary",
    "load_rate",
    "load_steps",
    "parse_messages",
    "quarantine_messages",
    "stamp_latency",
    "top_channels",
    "top_counted",
    "top_keys",
    "top_users",
    "with_steps",
]
