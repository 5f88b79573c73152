"""The registered queries, each beside the SQL that checks it."""

from __future__ import annotations


def catalog():
    """The registry with all queries loaded."""
    from loomwork.plans import (  # noqa: F401
        aggregates, jobs, joins, ordered, pictures, registry, sources, texts, vectors)

    return registry.REGISTRY
