"""Imports every module that registers queries."""

from checks import queries_columns  # noqa: F401
from checks import queries_matching  # noqa: F401
from checks import queries_reports  # noqa: F401
from checks import queries_scalars  # noqa: F401
from checks import queries_sources  # noqa: F401
