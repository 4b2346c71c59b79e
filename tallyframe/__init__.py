"""tallyframe: results-per-place analytics as plain Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built on Spark's own
primitives (no Python UDFs).  Column roles are described by a
:class:`~tallyframe.model.Layout`, so the same code serves an election file,
the TPC-H test bed, or any table with units, groups, counts and categories.
"""

from tallyframe.model import Layout, SPAIN_2016
from tallyframe.session import get_session, shared_dir

__all__ = ["Layout", "SPAIN_2016", "get_session", "shared_dir"]
