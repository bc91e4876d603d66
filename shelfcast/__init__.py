"""shelfcast: store-sales analytics and forecasting as plain Spark jobs."""

__version__ = "0.1.0"
