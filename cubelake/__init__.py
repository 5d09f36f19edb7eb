"""cubelake: keep a lake of statistical tables fresh and queryable with Spark."""

from cubelake.session import get_spark, scratch_dir, shared_root  # noqa: F401

__version__ = "0.1.0"
