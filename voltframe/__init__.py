"""voltframe: Spark-native hourly time-series preparation, description and
forecast evaluation, written as DataFrame compositions."""

__version__ = "0.1.0"
