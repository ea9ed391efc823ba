from usagelens.plans.config import DateRanges
from usagelens.plans.exploration import Exploration, exploration_report, explore
from usagelens.plans.jobs import explore_raw, monitoring_report, prepare, run, train_churn

__all__ = [
    "DateRanges",
    "Exploration",
    "exploration_report",
    "explore",
    "explore_raw",
    "monitoring_report",
    "prepare",
    "run",
    "train_churn",
]
