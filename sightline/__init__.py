"""A PySpark-native engine that turns web and search snapshots into ranked, clean, deduplicated records."""
