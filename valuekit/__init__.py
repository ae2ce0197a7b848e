"""Customer-value analytics on PySpark: marts, targets, stability, validation, calibration, scoring."""

__version__ = "0.1.0"
