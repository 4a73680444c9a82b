"""gridmart — electricity-market analytics as composable Spark DataFrame functions.

Layers (each a module of ``DataFrame -> DataFrame`` functions):

* ``sources``   — payload / catalogue JSON, raw observation table, seed CSV, test fixtures
* ``functions`` — reusable column expressions (calendars, rounding, shares, buckets)
* ``operators`` — ingest (normalise, reject, window, dedupe), upsert, staging,
                  hourly market, marts, reports, data-quality checks
* ``plans``     — end-to-end batch pipeline and the query registry
* ``streaming`` — incremental ingest of landed payload files with Structured Streaming
"""

from gridmart.session import build_session, ensure_utc

__all__ = ["build_session", "ensure_utc"]
