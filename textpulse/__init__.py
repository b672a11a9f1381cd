"""Text analytics over threaded discussions, as chainable Spark DataFrame operators."""

from textpulse.config import DEFAULT, Settings
from textpulse.session import get_session

__all__ = ["DEFAULT", "Settings", "get_session"]
