"""kbspark: document knowledge base analytics written as Spark DataFrame jobs."""
