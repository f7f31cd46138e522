"""Structured Streaming use of fitted generators and models."""
