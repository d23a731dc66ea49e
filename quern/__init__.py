"""quern: analytical operators, functions, sources and sinks over Spark DataFrames."""
