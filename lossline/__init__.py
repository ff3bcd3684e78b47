"""lossline: insurance claims analytics expressed as Spark DataFrame operators."""

from lossline.config import Config, StreamConfig

__all__ = ["Config", "StreamConfig"]
