"""Composed jobs: table runs, config rules, run log, reports."""
