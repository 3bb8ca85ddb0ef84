"""genoframe: genomic-interval analytics as Spark DataFrame plans."""
