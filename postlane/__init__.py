"""Queued messages to topic records, as ordinary Spark work."""

from postlane.options import IngestOptions, OptionError, delivery_mode
from postlane.shared import prepare

__all__ = ["IngestOptions", "OptionError", "delivery_mode", "prepare"]
