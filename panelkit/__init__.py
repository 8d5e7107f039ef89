"""panelkit: monthly entity panels on Spark.

Silver tables in, one gold row per (entity, month) out, then profiling and
leak-free ML preparation. Every operator is a DataFrame -> DataFrame (or
Column) function built from Spark SQL / DataFrame / ML primitives.
"""

from panelkit.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
