"""martloom: a shop-analytics warehouse expressed as PySpark DataFrame pipelines."""

from martloom.params import Params
from martloom.plans.warehouse import MODELS, Warehouse

__all__ = ["MODELS", "Params", "Warehouse"]
