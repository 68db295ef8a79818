"""strata — a layered commerce/traffic warehouse expressed as Spark DataFrame plans.

Layers (raw → detail → middle → summary):

* ``operators.logs``     raw app logs → start / page / display detail tables
* ``operators.cdc``      database change records → fact topics and dimension tables
* ``operators.traffic``  unique visitors, bounces, visitor statistics
* ``operators.orders``   order ⋈ line interval join, dimension enrichment, payments
* ``streaming``          Structured Streaming forms of the same operators
* ``plans``              whole batch DAGs and the query catalog
"""

from strata.config import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
