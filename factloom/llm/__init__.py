"""Operators for preparing large training corpora.

Every operator takes and returns DataFrames, keeps its own general
interface, and is wired to the test tables in :mod:`factloom.llm.queries`.
Nothing outside this subpackage imports it.
"""
