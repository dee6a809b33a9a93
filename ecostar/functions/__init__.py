"""Column expressions: payload parsing, time, scores and exact report averages."""
