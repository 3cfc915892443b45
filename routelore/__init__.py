"""routelore: a Spark-first engine for curating and evaluating routing datasets."""
