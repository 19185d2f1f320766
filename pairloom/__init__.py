"""Instruction-data preparation, batch text inference and scoring as Spark jobs."""
