"""Column-level rules shared by the plans."""
