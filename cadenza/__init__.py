"""cadenza: music catalog queries and maintenance jobs as Spark DataFrame plans.

Entry points:

* ``cadenza.session.build_session`` - a SparkSession with the settings the plans rely on
* ``cadenza.sources.files.load_catalog`` / ``save_catalog`` - the stored catalog
* ``cadenza.sources.jdbc.jdbc_catalog`` - the catalog read from its database
* ``cadenza.operators`` - search, credits, reports, profile, integrity, ingest, discovery
* ``cadenza.streaming.feeds`` - write jobs behind Structured Streaming
"""

from .catalog import Catalog
from .schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES

__all__ = ["Catalog", "FOREIGN_KEYS", "PRIMARY_KEYS", "TABLES"]
