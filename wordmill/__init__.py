"""wordmill: corpus ingestion, selection and word analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or a Column
expression) built from Spark SQL built-ins, so Catalyst plans the whole job
and the same code runs on ``local[*]`` or a large cluster.
"""

from wordmill.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
