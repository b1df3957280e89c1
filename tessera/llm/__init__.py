"""Operators for building training corpora: one module per operator.

Nothing else in the library imports this subpackage; the registered queries
are in ``tessera.llm.queries``.
"""
