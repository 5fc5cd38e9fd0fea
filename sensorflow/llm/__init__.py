"""Operators of a training-data pipeline: tokens, quality, repeats, copies, secrets, packing.

Nothing else in the library imports this subpackage.
"""
