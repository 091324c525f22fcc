from marquee.sources.messages import (
    decode_messages,
    parse_json_messages,
    publish_json,
    read_json_objects,
    read_offset_range,
    read_partition,
    stream_source,
    topic_options,
)
from marquee.sources.tables import ingest_csv, preview_table, scan_csv, scan_table, write_table

__all__ = [
    "decode_messages",
    "ingest_csv",
    "parse_json_messages",
    "preview_table",
    "publish_json",
    "read_json_objects",
    "read_offset_range",
    "read_partition",
    "scan_csv",
    "scan_table",
    "stream_source",
    "topic_options",
    "write_table",
]
