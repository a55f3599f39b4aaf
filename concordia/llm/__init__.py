"""Operators for preparing training data at scale.

Each module holds one operator with its own general interface; `queries.py`
derives the registered `opN_*` queries from them. Nothing else in the library
imports this subpackage.
"""
