"""Whole-cohort plans."""
