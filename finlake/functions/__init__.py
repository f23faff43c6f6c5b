"""Column expressions and fixed values (tag names) shared by the plans."""
