"""Column functions. Everything here stays inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTI_TEAM_SUFFIX = "TM"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def amount(col: Column | str) -> Column:
    """Exact decimal for adding up: the sum is the same in any order of rows,
    so retried or split tasks cannot change a result."""
    return _c(col).cast("decimal(24,8)")


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def ends_with_tm(col: Column | str) -> Column:
    """Multi-team marker; a null team is not one."""
    return F.right(_c(col), F.lit(2)).eqNullSafe(F.lit(MULTI_TEAM_SUFFIX))


def one_hot(col: Column | str, values: list[str]) -> list[Column]:
    """One 0/1 column per declared value, also for values that do not occur."""
    return [flag(_c(col) == v).alias(v) for v in values]


def first_digits(col: Column | str) -> Column:
    """First run of digits, null when there is none."""
    return F.nullif(F.regexp_extract(_c(col), r"(\d+)", 1), F.lit(""))


def split_element(col: Column | str, sep: str, index: int) -> Column:
    """Element ``index`` (from 0) of the split text, null when out of range."""
    literal = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.get(F.split(_c(col), literal), F.lit(index))


def parse_number(col: Column | str, strict: bool = False, kind: str = "double") -> Column:
    """Number from text: null when it does not parse, an error when ``strict``."""
    return _c(col).cast(kind) if strict else _c(col).try_cast(kind)


def clean_name(col: Column | str) -> Column:
    """Drop award marks, bracketed remarks and a trailing numeral of I's."""
    text = F.regexp_replace(_c(col), r"[*+]", "")
    text = F.regexp_replace(text, r"\(.*?\)", "")
    text = F.regexp_replace(F.trim(text), r"\s+I+$", "")
    return F.trim(text)


def to_timestamp(date: Column | str, time: Column | str, fmt: str = "yyyy-MM-dd h:mma") -> Column:
    """Timestamp without zone from a date text and a clock text such as 8:20PM."""
    return F.to_timestamp_ntz(F.concat_ws(" ", _c(date), _c(time)), F.lit(fmt))


def season_of(date: Column | str, first_month: int = 8) -> Column:
    """Year a season started in: dates before ``first_month`` belong to the year before."""
    year = F.year(_c(date))
    return F.when(F.month(_c(date)) >= first_month, year).otherwise(year - 1)


def snake_pick(team: Column | str, round_: Column | str, teams: int = 10) -> Column:
    """Overall pick of a team in a round when odd rounds run forward, even ones back."""
    team, round_ = _c(team), _c(round_)
    forward = (round_ - 1) * teams + team
    backward = round_ * teams - team + 1
    return F.when(round_ % 2 == 1, forward).otherwise(backward).cast("int")


def round_of_pick(pick: Column | str, teams: int = 10) -> Column:
    return F.expr(f"({_name(pick)} + {teams - 1}) div {teams}").cast("int")


def snake_team(pick: Column | str, teams: int = 10) -> Column:
    """Inverse of :func:`snake_pick`: number of the team that owns a pick."""
    seat = (_c(pick) - 1) % teams
    odd = round_of_pick(pick, teams) % 2 == 1
    return F.when(odd, seat + 1).otherwise(teams - seat).cast("int")


def pick_owner(pick: Column | str, teams: int = 10) -> Column:
    return F.concat(F.lit("team_"), snake_team(pick, teams).cast("string"))


def uniform_from_hash(*parts: Column) -> Column:
    """A number in (0, 1) fixed by its inputs, so a re-run task draws the same one."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    word = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return (word + 0.5) / F.lit(4294967296.0)


def _name(col: Column | str) -> str:
    if not isinstance(col, str):
        raise TypeError("name the column")
    return f"`{col}`"
