"""Date ranges of a run."""

import json
from dataclasses import dataclass


@dataclass(frozen=True)
class DateRanges:
    """ISO dates: the raw range to prepare and the processed range to train on."""

    start: str
    end: str
    processed_start: str
    processed_end: str

    @classmethod
    def from_json(cls, path: str) -> "DateRanges":
        with open(path) as file:
            given = json.load(file)
        return cls(
            given["start_date"],
            given["end_date"],
            given["processed_start"],
            given["processed_end"],
        )
