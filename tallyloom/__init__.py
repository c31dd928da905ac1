"""Onboarding of messy, sheet-shaped ledgers as PySpark DataFrame operators."""
