"""Names for helper columns beside columns of any name."""

from lexitab.operators.columns import unused

__all__ = ["unused"]
