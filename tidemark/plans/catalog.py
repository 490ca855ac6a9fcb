"""Imports every module that registers queries."""

from tidemark.plans import examples, inference, minute, research, scans, selection, series, trade  # noqa: F401
