"""Operators for preparing language-model training text.

Each module holds one operator with its own general interface;
``queries.py`` binds them to the registered ``opN_*`` queries. Nothing else
in the library imports this package.
"""
