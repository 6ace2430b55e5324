from tideline.sinks.files import (  # noqa: F401
    append_ingest_partitioned, append_partitioned, archive_by_time, batch_writer, guarded,
    stream_append,
)
from tideline.sinks.keyed import KeyedTable, upsert_sink  # noqa: F401
