"""Operators of a training-data pipeline over the text tables.

One module per operator; ``queries`` registers them. Nothing else in the
library imports this subpackage.
"""
