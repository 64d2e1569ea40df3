"""Operators for large training-data pipelines over text tables.

Nothing outside this subpackage imports it.  Each module holds one operator
with its own general interface; :mod:`lexiforge.llm.registry` holds the thin
``opN_<name>`` queries and their SQL.
"""
