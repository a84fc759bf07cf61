"""Column-expression helpers: every function returns a Catalyst ``Column``."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable.

    A Column used inside a higher-order-function lambda is re-evaluated for
    every element; binding it first (a one-element ``transform``) makes the
    lambda read a variable instead, keeping per-element work O(1).
    """
    return F.element_at(F.transform(F.array(value), fn), 1)
