"""Time-series bars, features and forecasts as Spark jobs."""
