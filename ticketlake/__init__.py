"""Problem-ticket ETL and KPI jobs for Apache Spark."""

__version__ = "0.1.0"
