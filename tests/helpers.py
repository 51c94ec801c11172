"""Small-table builders shared by the tests."""

from __future__ import annotations

import json
from datetime import datetime

from coursepulse import model


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def interactions(spark, rows):
    """Interactions from (student, course, type, time[, duration]) tuples."""
    full = [
        (r[0], r[1], r[2], at(r[3]) if r[3] else None, r[4] if len(r) > 4 else None, None, None)
        for r in rows
    ]
    return spark.createDataFrame(full, model.INTERACTION_SCHEMA)


def event(student, course, kind, time, duration=None, country="PERU", city="Lima"):
    return {
        "student_id": student, "course_code": course, "interaction_type": kind,
        "timestamp": time, "duration": duration,
        "location": {"country": country, "city": city},
    }


def messages(spark, values):
    """A bounded feed of raw message values."""
    rows = [(None if v is None else bytearray(v.encode()),) for v in values]
    return spark.createDataFrame(rows, "value binary")


def write_lines(path, events):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(e) + "\n" for e in events))


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)
