"""The day that a run calls today: one look at the clock, for everything in the run.

``current_date()`` is read again by every query, so a run over midnight would measure
account ages in one table from another day than activity in the next. ``run_date`` is
read once a process (``medallion.run`` stores it with the tables it writes); days are
those of the session's zone, UTC.
"""

from __future__ import annotations

import datetime as _dt
import functools


@functools.cache
def run_date() -> _dt.date:
    """Today in UTC, as first asked for in this process."""
    return _dt.datetime.now(_dt.timezone.utc).date()
