"""Column expressions: the audit envelope and row rules."""
