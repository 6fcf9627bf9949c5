"""Registered queries: each one runs an operator over whole tables."""

from lexloom.plans.registry import ORACLES, QUERIES  # noqa: F401
from lexloom.plans import projections  # noqa: F401
from lexloom.plans import filtering, flattening  # noqa: F401
from lexloom.plans import extraction  # noqa: F401
from lexloom.plans import matching  # noqa: F401
from lexloom.plans import auditing  # noqa: F401
from lexloom.plans import graphing, files  # noqa: F401
