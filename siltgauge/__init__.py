"""Data quality and observability for JSON transaction records on Spark."""

from .contract import RuleSet
from .operators.validate import validate

__all__ = ["RuleSet", "validate"]
