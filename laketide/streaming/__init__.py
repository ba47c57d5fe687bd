"""Structured Streaming form of the bronze event ingest.

The original pipeline picks up raw event files once a day.  The same
operator as a stream: new files in a folder are read as they arrive, each
event is stamped with every day it touches (its start day and its stop
day, the daily slices of ING2), and rows are appended to a date-partitioned
bronze table through the exactly-once file sink.  With
``trigger(availableNow=True)`` one run processes everything that arrived
since the last run and stops - the daily job, without re-reading old files.
"""

from laketide.streaming.ingest import start_event_ingest  # noqa: F401
