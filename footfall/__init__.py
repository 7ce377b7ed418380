"""footfall: daily clickstream analytics as composable Spark DataFrame functions."""
