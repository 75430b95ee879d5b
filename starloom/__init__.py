"""Star-schema building blocks on Spark: sources, dimensions, fact, checks, sinks."""
