"""Column names that can't meet those of a given table."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column has it in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
