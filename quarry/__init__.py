"""quarry: parameterised PySpark DataFrame operators for everyday analytics.

Sub-packages:

* ``sources``   – text / CSV / TSV / JSON readers with explicit schemas, text sinks
* ``functions`` – Column -> Column helpers (tokenising, log shaping, id hashing, arrays)
* ``operators`` – aggregates, top-k, joins, positional picks, similarity, graph, ML
* ``streaming`` – sliding-window counts and means, batch and Structured Streaming
* ``plans``     – the named queries over the driver tables (and their SQL oracles)
"""

from quarry.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
