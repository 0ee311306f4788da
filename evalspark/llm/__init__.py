"""Operators for training-data pipelines (language ID, dedup, packing, ...).

Nothing outside this subpackage imports it; ``queries`` registers one query per
operator. Removing the folder removes the operators and leaves the rest intact.
"""
