"""Spark-native knowledge extraction: long text in, entity graph tables out."""
