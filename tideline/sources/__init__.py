from tideline.sources.streams import json_stream, stream_source, table_stream  # noqa: F401
from tideline.sources.tables import inline_table, load  # noqa: F401
