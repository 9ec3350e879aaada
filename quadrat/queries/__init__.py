"""Every registered query; importing the package fills the registry."""

from quadrat.queries import (  # noqa: F401
    aggregates, cleaning, describing, econometrics, files, formats, jobs, joins, ordering, text, work,
)
from quadrat.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
