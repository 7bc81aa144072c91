"""The roles that columns play in a ranking problem; operators take column names from here, never as literals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """A query group is a time and an entity; its candidates are items; a label and a score belong to each."""

    time: str = "snap_date"
    entity: tuple[str, ...] = ("cust_id",)
    item: str = "prod_name"
    label: str = "label"
    score: str = "score"
    rank: str = "rank"

    @property
    def query(self) -> list[str]:
        return [self.time, *self.entity]

    @property
    def identity(self) -> list[str]:
        return [*self.query, self.item]


ROLES = Roles()
