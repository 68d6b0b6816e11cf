"""Trip-duration analytics on Spark: clean, profile, engineer, train, evaluate and score trip records."""

__version__ = "0.1.0"
