"""Company contact enrichment and corpus preparation as Spark DataFrame plans."""
