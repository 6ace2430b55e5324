from tideline.streaming.metrics import BatchMetrics, state_rows  # noqa: F401
from tideline.streaming.runner import StreamSpec, finish, run_all, start  # noqa: F401
