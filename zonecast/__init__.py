"""Point-in-time forecasting analytics on panels of time series, as Spark DataFrame jobs."""
