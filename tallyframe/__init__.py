"""Spark-native accounting lakehouse: raw documents to reconciled ledgers."""
