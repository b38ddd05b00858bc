"""Whole-table plans: the lake jobs and the registered queries."""
