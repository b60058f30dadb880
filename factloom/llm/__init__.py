"""Training-data operators: one module per operator, and a registry of their queries.

Nothing else in the library imports this subpackage; it may be removed as a whole.
"""
