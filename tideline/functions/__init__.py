from tideline.functions.decode import (  # noqa: F401
    epoch_ms, event_time, exact_money, json_decode, parse_time, payload_text,
    to_epoch_ms, to_ntz,
)
from tideline.functions.timeparts import with_time_parts  # noqa: F401
