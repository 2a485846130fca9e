"""Streaming: a file-arrival trigger for the full-refresh build.

The reference has no streaming operators (no watermarks, windows or state);
this package only replaces its manual trigger.
"""

from trip_star.streaming.rebuild import rebuild_on_new_files

__all__ = ["rebuild_on_new_files"]
