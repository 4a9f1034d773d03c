from .catalog import QUERIES
from .oracle import ORACLES

__all__ = ["QUERIES", "ORACLES"]
