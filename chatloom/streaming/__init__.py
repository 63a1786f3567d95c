from .commits import commit_latency, read_commits
from .counts import fold_counts, read_counts, store_counts
from .jobs import censor_job, format_job, run_job
from .latency import (
    latency_table,
    latency_totals,
    publish_latency,
    read_latency_stream,
    read_latency_table,
    unique_records,
    wide_table,
)
from .layout import compact_messages, finish_compaction, store_batch
from .progress import batch_durations, log_batches
from .sinks import read_latency, write_latency_stream, write_messages_stream

__all__ = [
    "batch_durations",
    "censor_job",
    "commit_latency",
    "compact_messages",
    "finish_compaction",
    "fold_counts",
    "format_job",
    "latency_table",
    "latency_totals",
    "log_batches",
    "publish_latency",
    "read_commits",
    "read_counts",
    "read_latency",
    "read_latency_stream",
    "read_latency_table",
    "run_job",
    "store_batch",
    "store_counts",
    "unique_records",
    "wide_table",
    "write_latency_stream",
    "write_messages_stream",
]
