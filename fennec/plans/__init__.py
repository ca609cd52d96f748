"""Composite estimators and jobs built from the operators."""
