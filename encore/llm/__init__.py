"""Training-data operators: formatting, quality, tokens, search, sharding, privacy, joins, mixing.

One module per operator (general interface and docstring contract), ``queries.py`` with the
registered ``opN_<name>`` queries and their SQL. Nothing outside this subpackage imports it.
"""
