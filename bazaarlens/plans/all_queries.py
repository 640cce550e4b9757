"""Imports every plan module so that its queries are registered."""

from bazaarlens.plans import creators, learning, live, market, primitives, sketches, tagging  # noqa: F401
from bazaarlens.plans.registry import ORACLE, QUERIES  # noqa: F401
