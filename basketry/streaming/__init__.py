from basketry.streaming.trends import MonthlyTrendStream

__all__ = ["MonthlyTrendStream"]
