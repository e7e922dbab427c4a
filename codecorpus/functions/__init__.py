"""Column functions: text rules, seeded draws and similarity."""
