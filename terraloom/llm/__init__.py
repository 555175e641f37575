"""Operators for preparing training data: cleaning, deduplication, scoring, search, token output.

Nothing else in the library imports this subpackage. Every operator takes a DataFrame with an id
and a text column (names are parameters), reads whole texts, treats a null text as empty unless
its docstring says otherwise, and ignores or keeps all further columns, whatever their names.
"""
