"""Readers: report files, and the driver tables bound as reports."""
