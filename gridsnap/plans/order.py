"""Windows over the explicit order of plays: every one is partitioned by game, half or drive."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


class Order:
    """Windows of a frame whose rows are ordered by ``by`` within ``game``."""

    def __init__(self, by: str = "row_order", game: str = "game_id", half: str = "half", drive: str = "drive_id") -> None:
        self.game = Window.partitionBy(game).orderBy(by)
        self.half = Window.partitionBy(game, half).orderBy(by)
        self.all_game, self.all_half, self.all_drive = (Window.partitionBy(*k) for k in ((game,), (game, half), (game, drive)))

    def lead(self, c: str) -> Column:
        return F.lead(c).over(self.game)

    def total(self, c: Column | str, half: bool = False) -> Column:
        """Running sum up to and with the row; null rows carry it on."""
        return F.sum(c).over((self.half if half else self.game).rowsBetween(Window.unboundedPreceding, 0))

    def before(self, c: Column | str, half: bool = False) -> Column:
        """The last entry up to the row."""
        return F.last(c, ignorenulls=True).over((self.half if half else self.game).rowsBetween(Window.unboundedPreceding, 0))

    def after(self, c: Column | str, half: bool = False) -> Column:
        """The next entry from the row on."""
        return F.first(c, ignorenulls=True).over((self.half if half else self.game).rowsBetween(0, Window.unboundedFollowing))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, null conditions too."""
    return F.when(condition, 1).otherwise(0)


def other_team(team: str, home: str = "home_team", away: str = "away_team") -> Column:
    """The opponent; null for a team that plays on neither side."""
    return F.when(F.col(team) == F.col(home), F.col(away)).when(F.col(team) == F.col(away), F.col(home))
