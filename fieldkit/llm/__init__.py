"""Operators for preparing text training data at scale.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries`` registers one query per operator.
"""
