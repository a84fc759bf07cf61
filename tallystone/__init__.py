"""tallystone: filing facts and filing text as Spark DataFrame operators.

Every public operator is a function ``DataFrame(s) -> DataFrame`` that only
builds a Catalyst plan; nothing is collected unless a function says so in its
docstring (and then only a size-checked, bounded set).
"""

from tallystone.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
