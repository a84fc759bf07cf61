"""Bindings of the operators to the driver tables, with DuckDB oracle SQL."""

from tallystone.plans.registry import ORACLE, QUERIES, table

# Import binding modules for their registrations.
from tallystone.plans import facts_plans as _facts  # noqa: F401,E402
from tallystone.plans import text_plans as _text  # noqa: F401,E402
from tallystone.plans import vector_plans as _vector  # noqa: F401,E402
from tallystone.plans import reconcile_plans as _reconcile  # noqa: F401,E402
from tallystone.plans import source_plans as _sources  # noqa: F401,E402
from tallystone.plans import stream_plans as _stream  # noqa: F401,E402

__all__ = ["ORACLE", "QUERIES", "table"]
