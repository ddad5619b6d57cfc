"""ledgerlens — payment-graph analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver.  Sub-packages:

* ``sources``   — payment log, category dictionaries, stored panels
* ``functions`` — column expressions (tokens, emoji classes, lifetime month)
* ``operators`` — clocks, text, profiles, graph metrics, PageRank, features, OLS
* ``plans``     — the named query catalogue and its DuckDB oracle text
* ``streaming`` — micro-batch classification of an arriving payment stream
"""

from ledgerlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
