"""Training-data operators: one module per operator, numbered as in the README.

Nothing outside this folder imports it; ``queries.py`` holds the registered
queries and ``oracle.py`` their SQL.
"""
