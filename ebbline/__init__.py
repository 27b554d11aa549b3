"""Clinical records analytics on Spark: sources, operators, functions, plans and streams."""
