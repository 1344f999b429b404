"""Running streams: starting queries and routing micro-batches."""
