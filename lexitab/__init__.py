"""Build, update, index and query large title -> value dictionaries on Spark."""
