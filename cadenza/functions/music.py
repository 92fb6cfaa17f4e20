"""Music-domain scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Note names of pitch classes 0..11 (0 = C, 11 = B).
PITCH_CLASS_NAMES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")


def key_name(column: str | Column) -> Column:
    """Note name for a key stored as a pitch-class integer (as number or text).

    Values that are already note names pass through; integers outside 0..11
    give NULL.
    """
    col = F.col(column) if isinstance(column, str) else column
    pc = col.cast("string").try_cast("int")
    names = F.array(*[F.lit(n) for n in PITCH_CLASS_NAMES])
    by_number = F.when(pc.between(0, 11), F.element_at(names, pc + 1))
    return F.when(pc.isNotNull(), by_number).otherwise(col.cast("string"))
