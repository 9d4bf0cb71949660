"""Whole batch runs, dashboard questions and quality reports."""
