from marquee.streaming.alerts import low_rated_stream
from marquee.streaming.sinks import (
    FencedError,
    merge_each_batch,
    overwrite_each_batch,
    publish_each_batch,
    read_merged,
    read_published,
)

__all__ = [
    "FencedError",
    "low_rated_stream",
    "merge_each_batch",
    "overwrite_each_batch",
    "publish_each_batch",
    "read_merged",
    "read_published",
]
