"""DataFrame to DataFrame operators: ordered windows, resampling, joins, models."""
