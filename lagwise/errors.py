"""Errors that stop a run instead of letting a wrong number through."""


class ContractError(ValueError):
    """A table does not have the columns its contract requires."""


class DataQualityError(RuntimeError):
    """A quality or leakage gate did not pass."""
