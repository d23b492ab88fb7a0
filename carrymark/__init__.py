"""Private-markets analytics as Spark DataFrame jobs.

``Catalog`` names the input relations; ``catalog.table(name)`` returns any
dimension, fact, bridge or mart as a lazy DataFrame.
"""

from carrymark.sources.catalog import Catalog

__all__ = ["Catalog"]
