"""plumbline: data-quality checks, repair and monitoring of a star schema as Spark jobs."""

from plumbline.operators.checks import Check, Suite
from plumbline.operators.validate import validate, validate_all
from plumbline.sources.registry import Warehouse

__all__ = ["Check", "Suite", "Warehouse", "validate", "validate_all"]
