"""Where the tables of one lake lie.

Bronze, silver, gold and reports are layers that change by one commit each; see ``sources.snapshots``. ``state``
holds what the last complete run read.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """A root folder, as any URI that Spark can read and write."""

    root: str

    def layer(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/squads"

    @property
    def players_flat(self) -> str:
        return f"{self.root}/silver/players_flat"

    @property
    def players(self) -> str:
        return f"{self.root}/silver/players"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver/quarantine"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def files(self) -> str:
        return f"{self.root}/state/files"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"

    def gold_table(self, group: str, name: str) -> str:
        return f"{self.gold}/{group}/{name}"
