"""Spark-native bulk processing of scanned documents: inventories, page geometry, text layers, batches."""
