"""E3 window minimum with late data.

Bounded: the firing changelog (one result per window firing: on time,
then once per allowed late row) plus the side output of too-late rows.
Streaming: ``streamweave.streaming.forms.window_min_stream`` keeps each window's
state until it closes and gives both outputs, rows too late for it marked as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from streamweave.operators.lateness import firing_changelog_min_by, late_output


def window_min_with_late_data(readings: DataFrame, size: str = "15 seconds", delay: str = "300 milliseconds",
                              lateness: str = "1 minute") -> tuple[DataFrame, DataFrame]:
    """(firing changelog, late rows) with the reference's defaults."""
    return (firing_changelog_min_by(readings, size, delay, lateness),
            late_output(readings, size, delay, lateness))
