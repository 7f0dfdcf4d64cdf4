"""perfkit: Spark-native profiling of Spark applications and versioned
embedding retrieval, written as DataFrame -> DataFrame functions."""

__version__ = "0.1.0"
