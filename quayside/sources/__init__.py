from quayside.sources.catalog import catalog, read_parquet
from quayside.sources.feeds import FEEDS, FEED_BY_KEY, Feed, expected, feeds, resolve_feed, resolve_feed_name
from quayside.sources.lines import read_lines, read_numbered_lines

__all__ = ["FEEDS", "FEED_BY_KEY", "Feed", "catalog", "expected", "feeds", "read_lines", "read_numbered_lines",
           "read_parquet", "resolve_feed", "resolve_feed_name"]
