"""Column-level building blocks: all are plan-time choices over built-in Spark functions."""
