"""Every operator as a query over the test tables, next to the same query in plain SQL."""

from __future__ import annotations

from .registry import REGISTRY


def load() -> dict:
    """Import all query modules and return the registry."""
    from . import (  # noqa: F401
        audits,
        cleaning,
        distributions,
        matching,
        rankings,
        segments,
        storage,
    )

    return REGISTRY
