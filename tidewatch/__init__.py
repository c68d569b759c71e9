"""Support-pressure analytics as PySpark DataFrame operators."""

from tidewatch.plans.warehouse import Warehouse
from tidewatch.settings import Settings

__all__ = ["Settings", "Warehouse"]
