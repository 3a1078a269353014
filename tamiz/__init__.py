"""tamiz: medallion-style analytics expressed as Spark DataFrame jobs."""
