"""paidpath: subscription-lifecycle analytics as PySpark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame built from built-in Spark
expressions, so Catalyst plans the whole chain (pruning, pushdown, join choice) and
the work runs in whole-stage codegen on the executors.
"""

from paidpath.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
