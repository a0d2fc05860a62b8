"""Rows of small results, for comparison."""

from __future__ import annotations


def as_dict(df, *key):
    """Rows by key: ``{key: rest}``."""
    found = {}
    for row in df.collect():
        rest = tuple(v for c, v in row.asDict().items() if c not in key)
        at = tuple(row[k] for k in key)
        at, rest = at[0] if len(at) == 1 else at, rest[0] if len(rest) == 1 else rest
        assert at not in found, f"{at} twice"
        found[at] = rest
    return found
