"""Statistics over large collections of forum comments, written for Spark."""
