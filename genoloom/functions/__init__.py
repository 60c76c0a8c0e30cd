"""Column expressions: no function here triggers work or touches a DataFrame."""
