"""Operators for preparing text collections at scale, with their registered queries."""
