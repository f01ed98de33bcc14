"""tokenloom: text and code corpus work as Spark jobs."""
