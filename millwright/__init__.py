"""Shop-floor and continuous-improvement analytics as Spark DataFrame plans."""

__version__ = "0.1.0"
