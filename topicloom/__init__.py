"""Document collections to labelled topic hierarchies, as Spark DataFrame jobs."""
