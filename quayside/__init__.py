"""Supply-chain export and planning write-back for ERP data on Spark."""

__version__ = "0.1.0"
