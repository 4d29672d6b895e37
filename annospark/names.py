"""Names for columns that an operator adds for itself."""

from __future__ import annotations


def free_name(wanted: str, taken) -> str:
    """``wanted``, or the first of ``wanted_1, wanted_2, ...`` that isn't taken."""
    name, n = wanted, 0
    while name in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name
