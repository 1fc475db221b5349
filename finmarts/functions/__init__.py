"""Column functions: numbers, calendar, business rules."""
