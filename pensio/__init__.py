"""Pension back-office analytics as Spark DataFrame plans."""
