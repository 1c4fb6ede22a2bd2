"""Label names, label binarization, confidence text and the per-row display line."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonestream.functions.clean import snippet

# Class names and the raw positive label of the six-column layout.
POSITIVE = "Positive"
NEGATIVE = "Negative"
RAW_POSITIVE = 4


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binarize_label(c: Column | str) -> Column:
    """``1`` if the raw label is 4, ``0`` for any other number; a null or
    non-numeric label (read through ``try_cast``) stays null, so training drops it."""
    v = _col(c).try_cast("int")
    return F.when(v == RAW_POSITIVE, F.lit(1)).when(v.isNotNull(), F.lit(0))


def prediction_int(c: Column | str) -> Column:
    """Model prediction (double) as int."""
    return _col(c).cast("int")


def label_name(c: Column | str) -> Column:
    """1 -> Positive, anything else -> Negative."""
    return F.when(_col(c) == 1, F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))


def label_name_strict(c: Column | str) -> Column:
    """0 -> Negative, 1 -> Positive, anything else -> null."""
    return F.when(_col(c) == 0, F.lit(NEGATIVE)).when(_col(c) == 1, F.lit(POSITIVE))


def _first_above(cents: int) -> float:
    """The smallest double that ``%.2f`` prints as ``cents + 1`` hundredths: halves go to
    the even hundredth, judged on the double's exact binary value."""
    half = Fraction(2 * cents + 1, 200)
    near = float(half)
    if Fraction(near) > half or (Fraction(near) == half and cents % 2):
        return near
    return math.nextafter(near, math.inf)


def two_decimals(p: Column | str) -> Column:
    """A probability as C and Python print it with ``%.2f``.

    Java rounds the shortest decimal text half up instead (0.125 -> 0.13,
    0.285 -> 0.29 where C has 0.12 and 0.28), so the hundredths come from exact
    thresholds. Values outside 0 to 1 are left to ``format_string``.
    """
    c = _col(p)
    floor = F.floor(c * 100).cast("int")
    steps = F.array(*[F.lit(_first_above(k)) for k in range(100)], F.lit(math.inf))
    cents = floor + (c >= F.get(steps, floor)).cast("int")
    return F.when(c.between(0.0, 1.0), F.format_string("%d.%02d", F.floor(cents / 100).cast("int"), cents % 100)).otherwise(
        F.format_string("%.2f", c))


def confidence_text(p_neg: Column | str, p_pos: Column | str) -> Column:
    """``n.nn/p.pp`` from the two class probabilities."""
    return F.concat(two_decimals(p_neg), F.lit("/"), two_decimals(p_pos))


def display_line(text: Column | str, pred: Column | str, p_neg: Column | str | None = None,
                 p_pos: Column | str | None = None, n: int = 120) -> Column:
    """``snippet -> Label (conf: n/p)``; without probabilities ``snippet -> Label``."""
    head = F.concat(snippet(text, n), F.lit(" -> "), label_name(pred))
    if p_neg is None or p_pos is None:
        return head
    return F.concat(head, F.lit(" (conf: "), confidence_text(p_neg, p_pos), F.lit(")"))
