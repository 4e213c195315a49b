"""rankbeam: learning-to-rank data preparation, features and metrics on Spark."""

from .config import Config

__all__ = ["Config"]
