"""Query catalogue: importing this package registers every query."""

from . import q_analytics, q_discover, q_enrich, q_extract, q_merge, q_run, q_sources  # noqa: F401
from .registry import REGISTRY  # noqa: F401
