"""Text helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywork.fixed_values import EMAIL_TAG


def normalise_email(email: Column) -> Column:
    """Lower-case the address and drop a ``+tag`` from its local part."""
    at = F.lit("@")
    local = F.regexp_replace(F.split_part(email, at, F.lit(1)), EMAIL_TAG, "")
    return F.lower(F.concat(local, at, F.split_part(email, at, F.lit(2))))
