"""Regional crop-yield analytics as composable Spark DataFrame operators."""
