"""Building blocks: joins, aggregations, version tracking."""
