"""Corpus operators for training data at scale.

Nothing else in the library imports this subpackage.  Its registered queries
are in :mod:`priorwise.llm.queries`.
"""
