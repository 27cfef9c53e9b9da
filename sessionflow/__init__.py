"""User sessions from usage events, kept right as late data arrives."""

from sessionflow.config import SessionConfig

__all__ = ["SessionConfig"]
