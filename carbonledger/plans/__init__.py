"""The model over the driver tables, the questions, and the query catalog."""

from .model import DriverModel, ModelSQL

__all__ = ["DriverModel", "ModelSQL"]
