"""Date text to a zone-free timestamp."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column) -> Column:
    """ISO text, with or without a trailing Z, as written; anything else (`NA` too) is null.

    The type has no zone, so a late evening stays in its month whatever the session zone is.
    """
    return F.nullif(text, F.lit("NA")).try_cast("timestamp_ntz")
