"""Typed conditions on a path: what was chosen at a given pick."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITION_PREFIX = "Avg"


@dataclass(frozen=True)
class Choice:
    """At ``pick``, one of the ids or one of the positions was chosen.

    ``where`` is an optional extra SQL predicate on the pick's row.
    """

    pick: int
    ids: tuple = ()
    positions: tuple = ()
    where: str | None = None

    def column(self, pick: str = "pick", key: str = "player_id", pos: str = "pos") -> Column:
        options = []
        if self.ids:
            options.append(F.col(key).isin(list(dict.fromkeys(self.ids))))
        if self.positions:
            options.append(F.col(pos).isin(list(dict.fromkeys(self.positions))))
        if self.where:
            options.append(F.expr(self.where))
        at_pick = F.col(pick) == self.pick
        if not options:
            return at_pick
        return at_pick & reduce(lambda a, b: a | b, options)


def make_choice(ids: Iterable, pick: int, positions: Sequence[str]) -> Choice:
    """Choice from entered ids; ``Avg<position>`` stands for the whole position."""
    chosen = list(dict.fromkeys(ids))
    whole = {f"{POSITION_PREFIX}{p}": p for p in positions}
    return Choice(
        pick,
        ids=tuple(i for i in chosen if i not in whole),
        positions=tuple(whole[i] for i in chosen if i in whole),
    )
