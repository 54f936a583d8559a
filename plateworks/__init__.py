"""plateworks: Spark-native analytics for compound screening and plate data."""
