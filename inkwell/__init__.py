"""inkwell: a Spark-first engine for curating labelled text-image datasets."""
