"""Spark jobs for labelled review text: checks, cleaning, training, scoring, profiling."""
