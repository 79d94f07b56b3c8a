"""Column in, column out: every function here stays inside generated code."""
