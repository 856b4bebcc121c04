"""millrace: lakehouse pipelines and engagement metrics as plain Spark jobs."""
