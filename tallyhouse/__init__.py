"""Membership billing reports as Spark DataFrame plans."""
