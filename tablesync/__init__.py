"""Keep target tables in step with streams of typed change records, on Spark DataFrames."""

from tablesync.spec import Field, MetaNames, SyncMode, StreamSpec
from tablesync.sources.store import TableStore

__all__ = ["Field", "MetaNames", "StreamSpec", "SyncMode", "TableStore"]
