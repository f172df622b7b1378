"""The reports: each takes its input frames and an explicit as_of, and returns named frames."""
