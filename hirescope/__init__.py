"""hirescope: posting demand analytics on Spark.

Modules: ``functions`` (rule tables, text cleaning, enrichment as Columns),
``operators`` (marts, lake queries, dedupe, reports, quality, dictionary
join), ``sources`` (readers / writers), ``plans`` (the weekly job, the
registered queries and their SQL oracles), ``streaming`` (landing stream).
"""

from .session import configure, local_session

__all__ = ["configure", "local_session"]
