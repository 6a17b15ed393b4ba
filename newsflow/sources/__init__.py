"""Readers and writers of the raw, staging and analytic layers."""
