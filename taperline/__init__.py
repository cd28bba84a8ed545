"""Athlete load analytics as Spark DataFrame plans."""

from taperline.plans.analytics import LoadAnalytics

__all__ = ["LoadAnalytics"]
