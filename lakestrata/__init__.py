"""lakestrata: a Spark-native card-portfolio medallion engine.

Bronze tables are typed and quality-flagged into Silver, checked for orphaned
foreign keys, joined and aggregated into six Gold entities and watched by
data-quality and reconciliation reports.  Every step is a DataFrame plan that
Catalyst/AQE optimise; nothing runs row-at-a-time in Python.
"""

__all__ = ["Medallion", "RunContext"]


def __getattr__(name):
    if name == "Medallion":
        from lakestrata.plans.medallion import Medallion

        return Medallion
    if name == "RunContext":
        from lakestrata.context import RunContext

        return RunContext
    raise AttributeError(name)
