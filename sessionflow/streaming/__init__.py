from sessionflow.streaming.stream import session_windows, start_session_stream

__all__ = ["session_windows", "start_session_stream"]
