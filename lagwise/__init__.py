"""lagwise: leak-free click analytics expressed as Spark DataFrame and MLlib jobs."""
from lagwise.config import Columns, Config, Splits
from lagwise.errors import ContractError, DataQualityError

__all__ = ["Columns", "Config", "ContractError", "DataQualityError", "Splits"]
