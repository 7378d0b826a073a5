"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  ``queries`` holds the thin
``opN_<name>`` queries, the sibling modules hold the operators with their general
interfaces.
"""
