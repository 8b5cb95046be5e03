"""Column expressions: null rules, small maths, calendar and text helpers."""
