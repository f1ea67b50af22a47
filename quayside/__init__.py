"""quayside: a PySpark library for landed, delimited daily feeds.

Feeds land as delimited text; quayside catalogues the landing zone, picks the
file of each feed, repairs quoting with column expressions, checks the shape,
builds tables, writes Parquet feed by feed and audits source against output.
Every operator is a DataFrame -> DataFrame (or Column -> Column) function.
"""

from quayside.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
