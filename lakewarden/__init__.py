"""PySpark toolkit for lakehouse ingestion, storage housekeeping and table registration."""
