"""Academic, finance and usage analytics written as Spark DataFrame jobs."""
