"""Which column plays which part."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Column roles of a training table.

    ``positive`` is the target value that counts as bad. With None it is the rarer of the two
    levels of the target, which is what "index 1" means when levels are ordered by frequency.
    ``id`` names a unique column; it settles the order among equal scores.
    ``continuous`` None means: every column that has no other role.
    """

    target: str
    id: str
    categorical: Sequence[str] = ()
    continuous: Sequence[str] | None = None
    positive: object = None

    def __post_init__(self):
        # A target that is also listed as categorical is still the target, never a feature.
        object.__setattr__(self, "categorical", tuple(c for c in self.categorical if c != self.target))
        if self.continuous is not None:
            object.__setattr__(self, "continuous", tuple(self.continuous))
