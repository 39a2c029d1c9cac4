"""tillbook: daily retail finance reports (bronze CSV -> silver -> gold) on Spark."""
