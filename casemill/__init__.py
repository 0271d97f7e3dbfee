"""casemill: governed analytics over semi-structured event reports, on Spark.

Every operator takes and returns DataFrames (or Columns), and ``functions`` only builds
expressions. Of the operators, ``profile``, ``model`` and ``dedup`` read small results to
decide what to do next, and ``clean`` reads the clock where no time is given.
"""

from casemill.layout import Zones
from casemill.spec import CleanSpec, JdbcSpec, RuleSpec, StreamSpec

__all__ = ["CleanSpec", "JdbcSpec", "RuleSpec", "StreamSpec", "Zones"]
