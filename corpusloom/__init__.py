"""Document analytics on Spark: catalogs, extraction, recovery, enrichment, work queues."""
