from sessionflow.sources.events import normalize_events, read_events, stream_events
from sessionflow.sources.files import archive_files, delete_path, new_work_path, path_exists
from sessionflow.sources.table import empty_sessions, read_session_table

__all__ = [
    "archive_files",
    "delete_path",
    "empty_sessions",
    "new_work_path",
    "normalize_events",
    "path_exists",
    "read_events",
    "read_session_table",
    "stream_events",
]
