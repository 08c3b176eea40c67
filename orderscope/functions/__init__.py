"""Column-level building blocks: exact money, text formats, hashed draws."""
