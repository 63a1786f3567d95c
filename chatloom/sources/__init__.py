from .messages import read_messages, read_messages_stream
from .selection import channel_counts, dataset_prefix, dataset_prefixes, subscribe_changes, subscribe_channels

__all__ = [
    "channel_counts",
    "dataset_prefix",
    "dataset_prefixes",
    "read_messages",
    "read_messages_stream",
    "subscribe_changes",
    "subscribe_channels",
]
