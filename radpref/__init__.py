"""Curating and grading preference-training data from AI-drafted radiology impressions, on Spark."""
