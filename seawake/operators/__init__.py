"""Operators: ``DataFrame -> DataFrame`` functions shared by batch and streams."""
