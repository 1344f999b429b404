"""Sources: message topics and stored tables."""
