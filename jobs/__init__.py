"""Runnable jobs: ``python -m jobs.study_tables`` and ``python -m jobs.review_intake``."""
