"""Paceline: event-outcome analytics expressed as Spark DataFrame operators."""
