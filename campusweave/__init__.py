"""Web pages to related tables, as Spark jobs."""
