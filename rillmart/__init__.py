"""Layered analytical tables over business change streams, as plain Spark plans."""
