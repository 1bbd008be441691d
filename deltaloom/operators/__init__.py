"""Batch operators over change frames and tables."""
