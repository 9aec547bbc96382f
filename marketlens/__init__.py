"""Real-time retail analytics on Spark: change logs and client logs to facts, windows and profiles."""
