"""Checked queries: operators over views of the given tables, each with its SQL twin."""
