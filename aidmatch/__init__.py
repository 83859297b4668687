"""Match help requests with nearby volunteers as Spark DataFrame jobs."""
