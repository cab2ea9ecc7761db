"""salesmart: a sales star schema, its incremental ledger and its reports, on Spark."""

from salesmart.session import build_session

__all__ = ["build_session"]
