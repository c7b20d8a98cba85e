"""DataFrame operators: ordering, deduplication, matching, reports, crawl tables."""
