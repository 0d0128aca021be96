from .counters import StreamCounters
from .runner import Hop, StreamRun, run_stream
from .state import state_snapshot, window_state, with_context

__all__ = ["Hop", "StreamCounters", "StreamRun", "run_stream", "state_snapshot",
           "window_state", "with_context"]
