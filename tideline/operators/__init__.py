from tideline.operators.clean import retail_clean, retail_rejects, typed_invoice  # noqa: F401
from tideline.operators.joins import (  # noqa: F401
    enrich, interval_join, interval_micros,
)
from tideline.operators.latest import latest_per_key, latest_semi  # noqa: F401
from tideline.operators.setops import union_tagged  # noqa: F401
from tideline.operators.upsert import merge_rows  # noqa: F401
from tideline.operators.windows import windowed_sum  # noqa: F401
