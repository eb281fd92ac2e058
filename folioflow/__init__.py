"""folioflow: captured case pages to a landing and a processed zone, as Spark jobs."""
