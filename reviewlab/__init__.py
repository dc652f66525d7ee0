"""Sentiment and text-feature analytics over rated reviews, written as Spark DataFrame jobs."""
