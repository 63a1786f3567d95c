"""Chat-message analytics on Spark: streams, stored tables and job timings."""
