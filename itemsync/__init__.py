"""Change-data-sync operators for mailbox content on Spark DataFrames."""

from itemsync.options import FieldRule, JobOptions
from itemsync.session import local_session, prepare

__all__ = ["FieldRule", "JobOptions", "local_session", "prepare"]
