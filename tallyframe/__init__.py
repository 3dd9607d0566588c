"""tallyframe: questionnaire records to analytical tables and statistics on Spark."""

from tallyframe.plans.policy import Policy

__all__ = ["Policy"]
