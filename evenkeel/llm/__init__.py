"""Operators for preparing the text of a training corpus.

Nothing else in the library imports this package.  All operators take whole
tables and whole texts; a null text counts as empty unless an operator says
otherwise, and columns they do not need are ignored or passed through.
"""
