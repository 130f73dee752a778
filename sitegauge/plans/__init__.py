"""Named queries over the driver's tables, each with its SQL oracle where one exists."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import (  # noqa: F401
    traffic, search, audit, corpus, markdown, linking, queues, selection, feeds)
