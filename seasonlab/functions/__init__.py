from seasonlab.functions.choices import Choice, make_choice
from seasonlab.functions.scalars import (
    amount,
    clean_name,
    ends_with_tm,
    first_digits,
    flag,
    one_hot,
    parse_number,
    pick_owner,
    round_of_pick,
    season_of,
    snake_pick,
    snake_team,
    split_element,
    to_timestamp,
    uniform_from_hash,
)
from seasonlab.functions.scoring import Scoring, linear_score

__all__ = [
    "Choice",
    "Scoring",
    "amount",
    "clean_name",
    "ends_with_tm",
    "first_digits",
    "flag",
    "linear_score",
    "make_choice",
    "one_hot",
    "parse_number",
    "pick_owner",
    "round_of_pick",
    "season_of",
    "snake_pick",
    "snake_team",
    "split_element",
    "to_timestamp",
    "uniform_from_hash",
]
