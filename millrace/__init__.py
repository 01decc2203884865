"""A Spark-first engine for curating timed, multimodal record collections."""
