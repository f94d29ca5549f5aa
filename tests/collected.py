"""Helper that the tests share; ``conftest`` is a name that a folder below has as well."""

from __future__ import annotations


def rows(df, *order: str) -> list[tuple]:
    """Collected rows as tuples, in a stable order."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
