"""Training-data operators. Nothing outside this package imports it."""

from leadloom.llm.queries import ORACLES, QUERIES  # noqa: F401
