"""Triggered streams: runs, checked and counted targets, change application, minutes."""

from larderlake.streaming.changes import ChangeSpec, apply_changes_stream, read_history, rebuild
from larderlake.streaming.checked import read_accepted, read_quarantined, run_checked
from larderlake.streaming.counts import read_counts, summed
from larderlake.streaming.enrich import stream_static_join
from larderlake.streaming.minutes import read_late, read_minutes, run_minutes
from larderlake.streaming.runs import checkpoint_dir, quality_metrics, run_available_now

__all__ = [
    "ChangeSpec",
    "apply_changes_stream",
    "checkpoint_dir",
    "quality_metrics",
    "read_accepted",
    "read_counts",
    "read_history",
    "read_late",
    "read_minutes",
    "read_quarantined",
    "rebuild",
    "run_available_now",
    "run_checked",
    "run_minutes",
    "stream_static_join",
    "summed",
]
