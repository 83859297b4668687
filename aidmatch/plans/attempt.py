"""One attempt over windowed records: matches, dead letters and records to try again."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aidmatch.operators.assignment import assign
from aidmatch.operators.leftovers import (
    add_attempt,
    leftovers,
    matched_pairs,
    retries,
    unmatched_requests,
    unmatched_volunteers,
)
from aidmatch.schemas import MAX_ATTEMPTS
from aidmatch.workspace import checkpointed


@dataclass
class Attempt:
    outcomes: DataFrame
    max_attempts: int = MAX_ATTEMPTS
    #: What was counted while the outcomes were written.
    counted: dict[str, int] = field(default_factory=dict)

    def saved(self) -> "Attempt":
        """The same with its outcomes written once, for several readers, and counted on the way, without a job of its own."""
        left = F.col("distance").isNull()
        over = F.coalesce("help.attempts", "volunteer.attempts", F.lit(0)) + 1 >= self.max_attempts
        seen = Observation()
        outcomes = checkpointed(self.outcomes.observe(
            seen,
            F.count("distance").alias("matched"),
            F.count_if(left & F.col("help").isNotNull()).alias("requests_left"),
            F.count_if(left & F.col("volunteer").isNotNull()).alias("volunteers_left"),
            F.count_if(left & over & F.coalesce("help.nivel_urgencia", "volunteer.nivel_urgencia").isNotNull()).alias("dead_requests"),
            F.count_if(left & over & F.coalesce("help.radio_disponible_km", "volunteer.radio_disponible_km").isNotNull()).alias("dead_volunteers"),
        ))
        return Attempt(outcomes, self.max_attempts, dict(seen.get))

    @property
    def left(self) -> DataFrame:
        return add_attempt(leftovers(self.outcomes))

    @property
    def matched(self) -> DataFrame:
        return matched_pairs(self.outcomes)

    @property
    def requests(self) -> DataFrame:
        return unmatched_requests(self.left, self.max_attempts)

    @property
    def volunteers(self) -> DataFrame:
        return unmatched_volunteers(self.left, self.max_attempts)

    def tables(self) -> dict[str, DataFrame]:
        """The three result tables, each row with the day of its window."""
        return {
            "matched_pairs": matched_pairs(self.outcomes, with_day=True),
            "unmatched_requests": unmatched_requests(self.left, self.max_attempts, with_day=True),
            "unmatched_volunteers": unmatched_volunteers(self.left, self.max_attempts, with_day=True),
        }

    @property
    def retries(self) -> DataFrame:
        return retries(self.left, self.max_attempts)


def attempt(windowed: DataFrame, max_attempts: int = MAX_ATTEMPTS, **bounds) -> Attempt:
    return Attempt(assign(windowed, **bounds), max_attempts)
