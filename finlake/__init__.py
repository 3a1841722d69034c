"""finlake: market analytics as Spark DataFrame, SQL, ML and streaming plans."""
