"""trendspark: content-popularity analytics as Spark DataFrame operators."""

from trendspark.session import get_session

__all__ = ["get_session"]
__version__ = "0.1.0"
