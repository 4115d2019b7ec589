"""Reusable jobs that the reports, the mart and the streams are built from."""
