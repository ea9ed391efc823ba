"""Reading a database table over JDBC, with bounded retry."""

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    """A table (or parenthesised subquery with an alias) behind a JDBC URL.

    ``column`` names the date column that splits the read of a range: one connection and
    one partition per calendar day. ``split`` names a whole-number column that cuts every
    day, and a read of the whole table, into ``parts`` by its remainder; without it a day is one
    partition, and the whole table too. Lost connections are tried again, other errors
    are raised at once.
    """

    url: str
    table: str
    column: str = "DP_DATE"
    split: str | None = None
    parts: int = 1
    properties: dict[str, str] = field(default_factory=dict)
    retries: int = 5
    delay: float = 10.0

    def day_predicates(self, start, end) -> list[str]:
        first, last = _as_date(start), _as_date(end)
        days = (first + timedelta(days=i) for i in range((last - first).days + 1))
        within = [
            f"{self.column} >= '{day}' AND {self.column} < '{day + timedelta(days=1)}'"
            for day in days
        ]
        return [" AND ".join(p for p in (day, part) if p) for day in within for part in self.part_predicates()]

    def part_predicates(self) -> list[str]:
        """One per part of the rows, together all of them; rows without a number are in the first."""
        if not self.split or self.parts < 2:
            return [""]
        remainder = f"ABS({self.split} % {self.parts})"
        first = f"({remainder} = 0 OR {self.split} IS NULL)"
        return [first, *[f"{remainder} = {i}" for i in range(1, self.parts)]]

    def read_range(self, spark: SparkSession, start, end) -> DataFrame:
        predicates = self.day_predicates(start, end)
        if not predicates:
            return self.read(spark).limit(0)
        return self._read(spark, predicates)

    def read(self, spark: SparkSession) -> DataFrame:
        predicates = self.part_predicates()
        return self._read(spark, predicates if predicates != [""] else None)

    def _read(self, spark: SparkSession, predicates: list[str] | None) -> DataFrame:
        options = {"predicates": predicates} if predicates else {}
        return self._retrying(
            lambda: spark.read.jdbc(self.url, self.table, properties=self.properties, **options)
        )

    def _retrying(self, attempt: Callable[[], DataFrame]) -> DataFrame:
        # read.jdbc fetches the schema at once, so a lost connection shows up here.
        error = None
        for turn in range(self.retries):
            if turn:
                time.sleep(self.delay)
            try:
                return attempt()
            except Exception as caught:
                if not _lost_connection(caught):
                    raise
                error = caught
        raise ConnectionError(f"no connection after {self.retries} attempts") from error


def _lost_connection(error: Exception) -> bool:
    """Whether a connection failed: SQLState class 08 or the names drivers give such errors."""
    if isinstance(error, OSError):
        return True
    cause = getattr(error, "java_exception", None)
    while cause is not None:
        name = cause.getClass().getName()
        if any(word in name for word in ("Connect", "Communications", "SocketException", "Timeout")):
            return True
        if hasattr(cause, "getSQLState") and str(cause.getSQLState() or "").startswith("08"):
            return True
        cause = cause.getCause()
    text = str(error).lower()
    return any(words in text for words in ("connection refused", "communications link", "timed out"))


def _as_date(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)
