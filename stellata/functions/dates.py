"""Date parsing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts met in the weather files, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy")


def parse_mixed_date(c, formats=DATE_FORMATS) -> Column:
    """First layout that parses wins; text that fits none gives NULL."""
    x = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.coalesce(*[F.try_to_date(x, f) for f in formats])
