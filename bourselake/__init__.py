"""Spark jobs that turn landed company disclosures into one complete record each."""
