"""Recruitment and pay analytics as Spark DataFrame functions."""
