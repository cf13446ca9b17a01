"""lakezones: batch lake pipelines on Spark.

Incremental extract with snapshot change detection, zone promotion, a
transform-and-load template for wide warehouse tables, a run ledger that is
the commit log of every batch, and an ML layer (split, assemble, logistic
regression, model selection, scoring, F1).  All data work is DataFrame /
Spark ML code that Catalyst plans.
"""

from .session import ensure_checkpoint_dir, local_session, scratch_dir, shared_root

__all__ = ["ensure_checkpoint_dir", "local_session", "scratch_dir", "shared_root"]
