"""The operators bound to the given tables, each with its SQL twin."""


def all_queries():
    """Builders and SQL by query name, in the order of the modules."""
    from catalog import landing  # noqa: F401
    from catalog import gold  # noqa: F401
    from catalog import history  # noqa: F401
    from catalog import operations  # noqa: F401
    from catalog import streams  # noqa: F401
    from catalog.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
