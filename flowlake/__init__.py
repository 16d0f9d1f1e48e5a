"""Network-flow analytics as composable Spark DataFrame functions."""
