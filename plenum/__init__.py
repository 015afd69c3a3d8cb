"""plenum: Spark-native cleaning, panel building and meeting-minutes
extraction for civic and regulatory data. Every operator is a function from
DataFrame (or Column) to DataFrame (or Column) with column names as
arguments."""

__version__ = "0.1.0"
