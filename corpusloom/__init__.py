"""corpusloom: corpus-graph analytics expressed as Spark DataFrame plans."""
