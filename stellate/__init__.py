"""stellate: star-schema ETL, profiling and quality checks as Spark DataFrame functions.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects built from
built-in Spark expressions, so Catalyst plans, prunes and pushes filters down.
"""

from stellate.session import build_session, checkpoint_root, cut_lineage, scratch_path

__all__ = ["build_session", "checkpoint_root", "cut_lineage", "scratch_path"]
