"""DataFrame operators.  Importing the package registers every pipeline step."""

from millrace.operators import columns, joins, normalise, rows  # noqa: F401
from millrace.operators.registry import STEPS, StepRegistry

__all__ = ["STEPS", "StepRegistry"]
