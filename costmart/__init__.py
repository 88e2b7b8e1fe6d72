"""costmart: spend analytics for cloud data platforms, written as PySpark DataFrame operators."""

from costmart.config import Config
from costmart.session import build_session

__all__ = ["Config", "build_session"]
