"""Episode analytics on Spark: DataFrame operators over multichannel time series."""
