"""End-to-end jobs. Only one-row summaries reach the driver."""
