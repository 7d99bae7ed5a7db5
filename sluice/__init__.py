"""Spark-native cleaning, auditing, publication and feature derivation for repeatedly collected records."""
