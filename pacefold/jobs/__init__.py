"""Command-line jobs: stream, batch, alerts, compact and publish."""
