"""daybook: point-in-time feature tables and table publishing on Spark.

Every operator takes and returns Spark DataFrames (or issues catalog SQL), so
all data work runs on executors and is planned by Catalyst.
"""

from daybook.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
