"""Operators for large text corpora, and their registered queries."""

from tidewater.llm.queries import PLANS, TWINS

__all__ = ["PLANS", "TWINS"]
