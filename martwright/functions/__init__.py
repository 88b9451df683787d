"""Column functions and business rules."""
