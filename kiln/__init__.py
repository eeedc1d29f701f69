"""kiln: Spark-native table profiling, cleaning plans, feature engineering and segmentation."""

__version__ = "0.1.0"
