"""Training-data pipeline operators over text and embedding tables.

Self-contained: nothing else in the library imports this package.
"""
