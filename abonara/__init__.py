"""abonara: subscriber analytics as plain Spark DataFrame functions."""
