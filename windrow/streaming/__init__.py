from windrow.streaming.sink import windowed_sink
from windrow.streaming.windows import finalize_window, tumbling_window, window_length

__all__ = ["finalize_window", "tumbling_window", "window_length", "windowed_sink"]
