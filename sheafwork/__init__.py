"""A knowledge-analytics engine on Spark: evidence, knowledge units, retrieval, collection sync and queues."""
