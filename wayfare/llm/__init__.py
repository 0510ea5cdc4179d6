"""Operators for building language-model training corpora.

Nothing outside this subpackage imports it.  Queries and their SQL are in
:mod:`wayfare.llm.queries`.
"""
