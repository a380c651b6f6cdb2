"""Number formatting rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_cents(column: str) -> Column:
    """Two decimals, decided by the exact binary value, ties to even.

    Spark's ``round`` works on the shortest decimal text of a double, so 2.675
    becomes 2.68 although the number stored is below the tie.  Only such
    apparent ties need care: the exact product of the value and 1000 is
    compared with the tie by an error-free multiplication, in which splitting
    the value into halves of 26 bits makes both partial products exact.
    """
    x = f"abs({column})"
    scaled = f"({x} * 1000D)"
    tie = f"rint({scaled})"
    big = f"({x} * 134217729D)"
    high = f"({big} - ({big} - {x}))"
    rest = f"(({high} * 1000D - {scaled}) + ({x} - {high}) * 1000D)"
    beyond = f"(({scaled} - {tie}) + {rest})"
    down = f"({beyond} < 0 OR ({beyond} = 0 AND ({tie} - 5) / 10 % 2 = 0))"
    at_tie = f"CASE WHEN {down} THEN ({tie} - 5) / 1000D ELSE ({tie} + 5) / 1000D END"
    is_tie = f"{tie} % 10 = 5 AND {tie} / 1000D = {x}"
    rounded = f"round(CASE WHEN {is_tie} THEN {at_tie} ELSE {x} END, 2)"
    return F.expr(f"CASE WHEN {column} < 0 THEN -{rounded} ELSE {rounded} END")
