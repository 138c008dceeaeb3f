"""From extracted events to the released table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.records import release
from ..schemas import RELEASE


def build(events: DataFrame, carry: tuple = (), fill_end: bool = False, position: str = "position") -> DataFrame:
    """The release columns, then those carried through."""
    return release(events, carry, fill_end, position).select(*RELEASE, *[c for c in carry if c not in RELEASE])
