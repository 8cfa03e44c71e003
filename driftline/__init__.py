"""driftline: Spark DataFrame operators that keep a tabular prediction product honest."""

from driftline.spec import Rule, TableSpec

__all__ = ["Rule", "TableSpec"]
