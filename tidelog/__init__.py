"""Change-feed and event-log analytics as plain Spark DataFrame operators."""
